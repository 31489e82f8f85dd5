"""Text normalisation, slugs and identifiers, all as native column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace under which point ids are minted.
POINT_NAMESPACE = "6f1d3c62-1f2a-5b7e-9c11-0a2b3c4d5e6f"

# Characters that bullet a line, next to white space.
BULLETS = "•●▪\\-*→"

# White space as the normaliser sees it: the Unicode property plus the four
# separator control characters, as a character class and spelled out.
WS = "\\p{IsWhite_Space}\\x1C-\\x1F"
WS_CHARS = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a variable.

    Whatever a lambda of `transform` or `filter` captures is evaluated again for
    every element, unless it is a plain column or such a variable.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, line ends included."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def stripped_length(c: Column | str) -> Column:
    return F.length(strip(c))


def tidy(c: Column | str) -> Column:
    """Clean one page of extracted text while every line keeps its place.

    The bullet class includes line ends, so blank lines disappear with it.
    """
    out = F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # a single blank is left alone, not replaced by itself
    out = F.regexp_replace(out, "[ \\t\\x{00A0}]{2,}|[\\t\\x{00A0}]", " ")
    out = F.regexp_replace(out, f"(?md)^[{WS}{BULLETS}]+", "")
    out = F.regexp_replace(out, f"[{WS}&&[^\\n]]+(?=\\n|\\z)", "")
    out = F.regexp_replace(out, "\\n{3,}", "\n\n")
    return strip(out)


def lines_of(c: Column | str) -> Column:
    return F.split(col(c), "\n")


def slugify(c: Column | str) -> Column:
    cleaned = F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "-")
    return F.btrim(cleaned, F.lit("-"))


def _short_provider(provider: Column | str) -> Column:
    return F.regexp_replace(col(provider), "^prov-", "")


def resource_id(provider: Column, domain: Column, category: Column, area_code: Column) -> Column:
    """A function of who, what and where, never of document or time."""
    parts = [_short_provider(provider), domain, category, area_code]
    return F.concat_ws("-", F.lit("res"), *[slugify(p) for p in parts])


def catalog_id(provider: Column, domain: Column, state_code: Column) -> Column:
    parts = [_short_provider(provider), domain, state_code]
    return F.concat_ws("-", F.lit("cat"), *[slugify(p) for p in parts])


def district_code(state_code: Column | str, name: Column | str) -> Column:
    slug = F.btrim(F.regexp_replace(col(name), "[^A-Za-z0-9]+", "-"), F.lit("-"))
    return F.concat(col(state_code), F.lit("-"), F.upper(slug))


def subject_code(slug: Column | str) -> Column:
    return F.replace(F.upper(col(slug)), F.lit("-"), F.lit("_"))


def alias_key(c: Column | str) -> Column:
    return F.lower(strip(c))


def uuid5(name: Column | str, namespace: str = POINT_NAMESPACE) -> Column:
    """Name-based UUID (RFC 9562 version 5)."""
    space = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(space, F.encode(col(name), "utf-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def point_id(provider: Column, document: Column, page: Column, ordinal: Column) -> Column:
    return uuid5(F.concat_ws(":", provider, document, page.cast("string"), ordinal.cast("string")))


def citation(document: Column | str, page: Column | str) -> Column:
    return F.concat(col(document), F.lit(" p."), col(page).cast("string"))


def schema_context(capability: Column, settings) -> Column:
    return F.concat(
        F.lit(settings.schema_base + "/"), capability,
        F.lit(f"/{settings.schema_version}/context.jsonld"),
    )


def schema_context_ref(capability: Column, settings) -> Column:
    return F.concat(
        schema_context(capability, settings), F.lit(f"#{settings.type_prefix}:"), capability
    )


def capability_of(type_name: Column | str) -> Column:
    """`prefix:Name` to `Name`; a name without prefix stays."""
    return F.regexp_replace(col(type_name), "^[^:]*:", "")


def wire_time(c: Column) -> Column:
    """UTC, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def token_count(c: Column | str) -> Column:
    """White-space separated tokens."""
    return F.regexp_count(col(c), F.lit("\\S+"))


def occurrences(c: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    gone = F.length(F.replace(col(c), F.lit(needle), F.lit("")))
    return ((F.length(col(c)) - gone) / F.lit(len(needle))).cast("int")


def literal(value, ddl: str) -> Column:
    """A list or mapping as one literal of type `ddl`. Parsed once, when the
    optimizer folds it; thousands of entries cost one call."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def string_array(values: Iterable[str]) -> Column:
    values = list(values)
    if not values:
        return F.array().cast("array<string>")
    return literal(values, "array<string>")
