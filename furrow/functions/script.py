"""Which script a text is in, whether its encoding is sound, and the glyph repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, occurrences

# Language, script, first and last code point, and the languages
# that share the script and cannot be told apart by it.
SCRIPTS = (
    ("hi", "Devanagari", 0x0900, 0x097F, ("hi", "mr", "ne", "sa", "kok")),
    ("bn", "Bengali", 0x0980, 0x09FF, ("bn", "as")),
    ("pa", "Gurmukhi", 0x0A00, 0x0A7F, ()),
    ("gu", "Gujarati", 0x0A80, 0x0AFF, ()),
    ("or", "Odia", 0x0B00, 0x0B7F, ()),
    ("ta", "Tamil", 0x0B80, 0x0BFF, ()),
    ("te", "Telugu", 0x0C00, 0x0C7F, ()),
    ("kn", "Kannada", 0x0C80, 0x0CFF, ()),
    ("ml", "Malayalam", 0x0D00, 0x0D7F, ()),
)
# Marks used in otherwise Latin text, which say nothing.
NEUTRAL = "[।॥₹]"
# Frequent Hindi function words, and how many per thousand
# Devanagari characters sound text has at least.
HINDI_MARKERS = ("के", "में", "और", "से", "है", "को", "का", "की", "पर", "इस")
HEALTHY_PER_1K = 10.0
# The two glyphs one producer swaps, and two literal corrections.
SWAPPED = ("बि", "िब")
CORRECTIONS = (("ीं", "ं"), ("्ी", "ी"))


def _span(lo: int, hi: int) -> str:
    return f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}"


def chars_in(c: Column | str, spans: str) -> Column:
    """Characters of `c` inside the class body `spans`."""
    return F.length(F.regexp_replace(col(c), f"[^{spans}]+", ""))


def letters(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), "\\P{L}+", ""))


def script_counts(c: Column | str, scripts=SCRIPTS) -> Column:
    """One struct per script, in table order; `rank` breaks ties."""
    return F.array(*[
        F.struct(
            chars_in(c, _span(lo, hi)).alias("n"),
            F.lit(-i).alias("rank"),
            F.lit(lang).alias("language"),
            F.lit(script).alias("script"),
            F.array(*[F.lit(s) for s in siblings]).cast("array<string>").alias("siblings"),
        )
        for i, (lang, script, lo, hi, siblings) in enumerate(scripts)
    ])


def _any_script(scripts) -> str:
    return _span(min(s[2] for s in scripts), max(s[3] for s in scripts))


def detect(c: Column | str, settings, scripts=SCRIPTS) -> Column:
    """LanguageReading struct for one text.

    The nine script counts run only for texts that hold a character of any of
    those blocks, so Latin text pays for one search.
    """
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), NEUTRAL, "")
    any_script = _any_script(scripts)

    def measured(t):
        top = F.when(t.rlike(f"[{any_script}]"), F.array_max(script_counts(t, scripts)))
        return F.struct(letters(t).alias("letters"), top.alias("top"))

    return let(text, lambda t: let(measured(t), lambda m: _reading(m, settings)))


def _reading(measured: Column, settings) -> Column:
    """The verdict on one text, from its letter count and strongest script."""
    n_letters, top = measured["letters"], measured["top"]
    # Without letters the script count is not looked at.
    n = F.when(n_letters > 0, F.coalesce(top["n"], F.lit(0))).otherwise(0)
    ratio = F.when(n_letters > 0, n / n_letters).otherwise(F.lit(0.0))
    accepted = (n_letters > 0) & (n >= settings.lang_min_chars) & (ratio >= settings.lang_min_ratio)
    siblings = F.when(accepted, top["siblings"]).otherwise(F.array().cast("array<string>"))
    reason = (
        F.when(n_letters == 0, F.lit("no letters"))
        .when(n == 0, F.lit("no Indic script present"))
        .when(n < settings.lang_min_chars,
              F.concat(top["script"], F.lit(f" present but below {settings.lang_min_chars}-char floor")))
        .when(ratio < settings.lang_min_ratio,
              F.concat(top["script"], F.lit(f" present but below {settings.lang_min_ratio:.0%} share")))
        .otherwise(F.concat(F.lit("dominant script is "), top["script"]))
    )
    return F.struct(
        F.when(accepted, top["language"]).otherwise("en").alias("language"),
        F.when(accepted, top["script"]).otherwise("Latin").alias("script"),
        n.alias("script_chars"),
        n_letters.alias("letter_chars"),
        ratio.alias("ratio"),
        (F.size(siblings) > 0).alias("ambiguous"),
        siblings.alias("siblings"),
        reason.alias("reason"),
    )


def language(c: Column | str, settings) -> Column:
    """The language that `detect` finds. A text without a character of any known script is English, and one search
    settles that."""
    found = col(c).rlike(f"[{_any_script(SCRIPTS)}]")
    return F.when(found, detect(c, settings)["language"]).otherwise("en")


def languages_of(texts: Column, settings) -> Column:
    """Language of each element of an array of texts, in order."""
    return F.transform(texts, lambda t: language(t, settings))


DEVANAGARI = f"[{_span(0x0900, 0x097F)}]"


def devanagari_chars(c: Column | str) -> Column:
    return chars_in(c, _span(0x0900, 0x097F))


def marker_hits(c: Column | str, markers=HINDI_MARKERS) -> Column:
    total = F.lit(0)
    for m in markers:
        total = total + occurrences(c, m)
    return total


def encoding(chars: Column, hits: Column, healthy_per_1k: float = HEALTHY_PER_1K) -> Column:
    """EncodingReading from (possibly aggregated) character and marker counts."""
    def reading(v):
        per_1k = F.when(v["chars"] > 0, F.lit(1000.0) * v["hits"] / v["chars"]).otherwise(F.lit(0.0))
        return F.struct(
            v["chars"].alias("script_chars"), v["hits"].alias("marker_hits"), per_1k.alias("markers_per_1k"),
            ((v["chars"] == 0) | (per_1k >= healthy_per_1k)).alias("healthy"))

    return let(F.struct(chars.alias("chars"), hits.alias("hits")), reading)


def repair_glyphs(c: Column | str, swapped=SWAPPED, matra: str = "ि",
                  consonants: str = "\\x{0915}-\\x{0939}", corrections=CORRECTIONS) -> Column:
    """Undo swapped glyphs and a vowel sign typed before its consonant.

    A pure transform: it harms sound text, so a caller compares both versions
    against known terms before it keeps this one.
    """
    out = F.translate(col(c), swapped[0], swapped[1])
    out = F.regexp_replace(out, f"{matra}([{consonants}])", f"$1{matra}")
    for wrong, right in corrections:
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out
