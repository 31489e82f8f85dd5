"""Section headings: which districts a heading names, and how long it governs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, lines_of, strip
from .lexicon import Lexicon, Matcher, districts_of

# An English heading phrase with the name in group 1, or a Hindi
# name before a word for district, in group 2.
HEADING = (
    r"(?i)agro-?met\s+advisor\w*(?:\s+service)?(?:\s+bulletin)?\s+for\s+(?:the\s+)?"
    r"([A-Za-z /&()\-]{3,60}?)\s+district"
    r"|([\x{0900}-\x{097F}][\x{0900}-\x{097F} \-]{2,40})\s*(?:जिला|जनपद|िनपद)"
)
# What separates several names in one heading.
NAME_SEPARATOR = r"[/,&]| and "


@dataclass(frozen=True)
class HeadingRule:
    """First match only; `groups` are tried in order for the name."""

    pattern: str = HEADING
    groups: tuple[int, ...] = (1, 2)
    separator: str = NAME_SEPARATOR


def heading_name(text: Column, rule: HeadingRule) -> Column:
    found = F.lit("")
    for g in reversed(rule.groups):
        found = let(F.regexp_extract(text, rule.pattern, g), lambda part, after=found: F.when(part != "", part).otherwise(after))
    return strip(found)


def heading_areas(text: Column, state: Column, lexicon: Lexicon, rule: HeadingRule) -> Column:
    """Codes of the districts named by the first heading in `text`, in order of
    the heading's parts, each once. Empty when there is none."""
    matcher = Matcher(lexicon.aliases("district"))

    def named(name):
        by_part = F.transform(
            F.split(name, rule.separator),
            lambda part: let(matcher.mentions(strip(part)), lambda hits: districts_of(hits, state, lexicon)),
        )
        return F.when(name != "", F.array_distinct(F.flatten(by_part)))

    # Most texts hold no heading, and one search settles that: that for the name, where there is one group.
    areas = let(heading_name(text, rule), named)
    areas = areas if len(rule.groups) == 1 else F.when(text.rlike(rule.pattern), areas)
    return F.coalesce(areas, F.array().cast("array<string>"))


def page_heading(text: Column, state: Column, lexicon: Lexicon, rule: HeadingRule) -> Column:
    """Districts of the page's last heading line; null when no line is one.

    All lines are read before the first block, so this heading governs even the
    blocks above it. Most pages have none, and one search settles that.
    """
    areas = F.filter(
        F.transform(lines_of(text), lambda line: heading_areas(line, state, lexicon, rule)),
        lambda a: F.size(a) > 0,
    )
    return F.when(text.rlike(rule.pattern), F.try_element_at(areas, F.lit(-1)))


def fill_blocks(heads: Column) -> Column:
    """For an array of heading area lists, the last non-empty one at or before
    each place, null where there is none yet."""
    kind = "array<string>"
    zero = F.expr(f"named_struct('done', cast(array() as array<{kind}>), 'last', cast(null as {kind}))")

    def after(s, a):
        return let(F.when(F.size(a) > 0, a).otherwise(s["last"]).cast(kind), lambda own: F.struct(
            F.array_append(s["done"], own).alias("done"), own.alias("last")))

    return F.aggregate(heads, zero, after, lambda s: s["done"])


def last_heading(heads: Column) -> Column:
    """The last non-empty heading area list of an array, or null."""
    return F.try_element_at(F.filter(heads, lambda a: F.size(a) > 0), F.lit(-1))
