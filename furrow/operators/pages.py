"""Page-level gates, and the per-document decisions made from all pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import script
from ..functions.text import string_array, strip, stripped_length
from ..settings import Settings
from .lexicon import Lexicon, Matcher, districts_of, to_canonical


def usable(text: Column | str, settings: Settings) -> Column:
    return stripped_length(text) >= settings.min_page_chars


def scan_gate(pages: DataFrame, settings: Settings, key: str = "document") -> DataFrame:
    """Per document: does enough of it carry a text layer?"""
    out = pages.groupBy(key).agg(
        F.count("*").alias("pages"),
        F.count_if(usable("text", settings)).alias("usable_pages"),
    )
    return _gate_columns(out, settings)


def _gate_columns(df: DataFrame, settings: Settings) -> DataFrame:
    ratio = F.col("usable_pages") / F.greatest(F.col("pages"), F.lit(1))
    return df.withColumn("usable_ratio", ratio).withColumn(
        "readable", (F.col("usable_pages") > 0) & (F.col("usable_ratio") >= settings.min_usable_ratio)
    )


def thin_report(pages: DataFrame, settings: Settings, key: str = "document") -> DataFrame:
    """Pages that pass the gate with next to nothing on them, and whether the
    share of unread pages deserves a warning."""
    measured = pages.select(key, "ocr", F.length("text").alias("chars"), stripped_length("text").alias("body_chars"))
    counted = measured.groupBy(key).agg(F.count("*").alias("pages"), *thin_counts(settings))
    return with_thin_warning(counted, settings)


def thin_counts(settings: Settings) -> list[Column]:
    """Aggregates over `ocr`, `chars` and `body_chars` of pages."""
    n = F.col("body_chars")
    return [
        F.sum("chars").alias("char_count"),
        F.count_if("ocr").alias("ocr_pages"),
        F.count_if(~F.col("ocr") & (n >= settings.min_page_chars) & (n < settings.thin_page_chars)).alias("thin_pages"),
        F.count_if(n < settings.min_page_chars).alias("empty_pages"),
    ]


def with_thin_warning(counted: DataFrame, settings: Settings) -> DataFrame:
    share = F.col("unread_pages") / F.greatest(F.col("pages"), F.lit(1))
    return counted.withColumn("unread_pages", F.col("thin_pages") + F.col("empty_pages")).withColumn(
        "thin_warning", (F.col("unread_pages") > 0) & (share >= settings.thin_warning_ratio))


def is_picture(text: Column | str, has_image: Column | str, settings: Settings) -> Column:
    """A page whose content is an image, even if a heading stands in text."""
    image = F.col(has_image) if isinstance(has_image, str) else has_image
    return image & (stripped_length(text) < settings.ocr_page_text_floor)


def _terms_found(text: Column, terms: list[str]) -> Column:
    """Terms contained in the text."""
    if not terms:
        return F.array().cast("array<string>")
    held = F.filter(string_array(terms), lambda t: F.contains(text, t))
    if any(t.isascii() for t in terms):
        return held
    beyond = F.octet_length(text) > F.length(text)
    return F.when(beyond, held).otherwise(F.array().cast("array<string>"))


def repair_scores(pages: DataFrame, terms: list[str], repair=script.repair_glyphs,
                  key: str = "document") -> DataFrame:
    """Known terms of each document before and after the glyph repair."""
    return score_terms(pages.select(
        key, _terms_found(F.col("text"), terms).alias("before"),
        _terms_found(repair(F.col("text")), terms).alias("after")), key)


def score_terms(found: DataFrame, key: str = "document") -> DataFrame:
    """A term counts once per document, so the shuffle carries distinct
    (document, term) pairs, combined map-side."""
    tag = lambda v, c: F.transform(c, lambda t: F.struct(F.lit(v).alias("v"), t.alias("t")))
    hits = found.select(key, F.explode_outer(F.concat(tag("b", "before"), tag("a", "after"))).alias("hit"))
    return (
        hits.groupBy(key, "hit").agg(F.lit(1).alias("one"))
        .groupBy(key).agg(
            F.count_if(F.col("hit.v") == "b").alias("terms_before"),
            F.count_if(F.col("hit.v") == "a").alias("terms_after"),
        )
        .withColumn("repair_applied", F.col("terms_after") > F.col("terms_before"))
    )


def state_flag(text: Column, document: Column, lexicon: Lexicon) -> Column:
    """Place, in priority order, of the first state a page or its file name
    gives; null when neither gives one."""
    low, name = F.lower(text), F.lower(document)
    choice = F.lit(None).cast("int")
    for i, s in reversed(list(enumerate(lexicon.states))):
        named = F.lit(False)
        for m in s.markers:
            named = named | F.contains(low, F.lit(m)) | F.contains(name, F.lit(m))
        choice = F.when(named, i).otherwise(choice)
    return choice


def states_from_flags(flags: DataFrame, columns: list[str], lexicon: Lexicon, key: str = "document",
                      head_pages: int = 4) -> DataFrame:
    """Best flag of the first pages. The rank limit runs before the shuffle: a
    document of any length sends four rows per task."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy("page"))
    heads = flags.select(key, "page", *columns).withColumn("_rank", rank).where(F.col("_rank") <= head_pages)
    codes = F.array(*[F.lit(s.code) for s in lexicon.states])
    return heads.groupBy(key).agg(*[F.get(codes, F.min(c)).alias(c) for c in columns])


def state_of(pages: DataFrame, lexicon: Lexicon, key: str = "document") -> DataFrame:
    """State of each document: the first state, in priority order, named by the
    file name or by one of the first pages. Null when none is."""
    flags = pages.select(key, "page", state_flag(F.col("text"), F.col(key), lexicon).alias("state_code"))
    return states_from_flags(flags, ["state_code"], lexicon, key)


def page_features(pages: DataFrame, lexicon: Lexicon, settings: Settings) -> DataFrame:
    """Everything a document is judged by, as a few bytes per page."""
    terms, text, name = lexicon.script_terms(), F.col("text"), F.col("document")
    fixed = script.repair_glyphs(text)
    return pages.select(
        "document", "page", usable("text", settings).alias("usable"),
        state_flag(text, name, lexicon).alias("_plain"),
        (state_flag(fixed, name, lexicon) if terms else F.lit(None).cast("int")).alias("_repaired"),
        _terms_found(text, terms).alias("before"), _terms_found(fixed, terms).alias("after"),
    )


def repair_decisions(pages: DataFrame, lexicon: Lexicon, settings: Settings) -> DataFrame:
    """One row per document: readable?, repaired? Whatever its state."""
    gate = scan_gate(pages, settings)
    return gate.join(repair_scores(pages, lexicon.script_terms()), "document")


def document_decisions(pages: DataFrame, lexicon: Lexicon, settings: Settings, store=None) -> DataFrame:
    """One row per document: readable?, repaired?, which state?

    Text is read once, into page features; `store` writes these for the three
    aggregates that follow. No page text is shuffled.
    """
    features = page_features(pages, lexicon, settings)
    features = store(features, "page-features") if store else features
    gate = _gate_columns(features.groupBy("document").agg(
        F.count("*").alias("pages"), F.count_if("usable").alias("usable_pages")), settings)
    merged = (
        gate.join(score_terms(features), "document")
        .join(states_from_flags(features, ["_plain", "_repaired"], lexicon), "document")
    )
    state = F.when(F.col("repair_applied"), F.col("_repaired")).otherwise(F.col("_plain"))
    return with_status(merged.withColumn("state_code", state).drop("_plain", "_repaired"))


def with_status(decisions: DataFrame) -> DataFrame:
    """`ok`, or `refused` with the reason. Failures are a different matter and
    are only known after extraction."""
    share = F.format_string("%d of %d pages have a text layer", F.col("usable_pages"), F.col("pages"))
    return decisions.withColumns({
        "status": F.when(F.col("readable") & F.col("state_code").isNotNull(), "ok").otherwise("refused"),
        "reason": F.when(~F.col("readable"), share)
        .when(F.col("state_code").isNull(), F.lit("names no known state")),
    })


def apply_decisions(pages: DataFrame, decisions: DataFrame, settings: Settings) -> DataFrame:
    """Pages of accepted documents, repaired where that was decided."""
    kept = decisions.where(F.col("status") == "ok").select("document", "state_code", "repair_applied")
    # One narrow row per document: broadcast while few, and beyond that Spark splits a document that fills its partition.
    joined = pages.join(kept, "document")
    text = F.when(F.col("repair_applied"), script.repair_glyphs(F.col("text"))).otherwise(F.col("text"))
    return joined.withColumn("text", text).drop("repair_applied")


# -- recovered page text ---------------------------------------------------------

def known_terms(text: Column, lexicon: Lexicon) -> Column:
    """Distinct subjects plus, per state, distinct districts a text names."""
    hits = Matcher(lexicon.aliases("subject") + lexicon.aliases("district")).mentions(text)
    total = F.size(to_canonical(hits, lexicon.rows("subject")))
    for s in lexicon.states:
        total = total + F.size(districts_of(hits, F.lit(s.code), lexicon))
    return total


def accept_recovered(pages: DataFrame, lexicon: Lexicon, settings: Settings) -> DataFrame:
    """Keep recovered text only where it demonstrably helps.

    Input has `text`, `recovered` (null when the page was not attempted) and
    `error`. Recovered text goes below the page's own text, whose heading is
    trusted.
    """
    merged = strip(F.concat(F.col("text"), F.lit("\n"), F.col("recovered")))
    topics = to_canonical(
        Matcher(lexicon.aliases("topic")).mentions(F.coalesce("recovered", F.lit(""))), lexicon.rows("topic"))
    scored = pages.withColumns({
        "terms_before": known_terms(F.col("text"), lexicon),
        "_merged": merged,
    }).withColumns({
        "_after": F.when(F.col("_merged").isNotNull(), known_terms(F.col("_merged"), lexicon)),
    })
    accepted = F.coalesce(
        (F.col("_after") > F.col("terms_before"))
        & (stripped_length("recovered") >= settings.ocr_min_chars)
        & (F.size(topics) >= settings.ocr_min_topics),
        F.lit(False),
    )
    return scored.withColumn("ocr_accepted", accepted).withColumns({
        "chars_before": stripped_length("text"),
        "ocr_attempted": F.col("recovered").isNotNull() | F.col("error").isNotNull(),
        "terms_after": F.when(F.col("ocr_accepted"), F.col("_after")).otherwise(F.col("terms_before")),
        "text": F.when(F.col("ocr_accepted"), F.col("_merged")).otherwise(F.col("text")),
        "ocr": F.col("ocr") | F.col("ocr_accepted"),
    }).withColumn(
        "chars_after",
        F.when(F.col("ocr_accepted"), F.length("text")).otherwise(F.col("chars_before")),
    ).drop("_merged", "_after")


def recovery_report(scored: DataFrame) -> DataFrame:
    """Per document: attempted, accepted and errored pages are kept apart."""
    return scored.groupBy("document").agg(
        F.count_if("ocr_attempted").alias("pages_attempted"),
        F.count_if("ocr_accepted").alias("pages_accepted"),
        F.count_if(F.col("error").isNotNull()).alias("pages_errored"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("page"))).alias("first_error"),
        F.sum("chars_before").alias("chars_before"),
        F.sum("chars_after").alias("chars_after"),
        F.sum("terms_before").alias("terms_before"),
        F.sum("terms_after").alias("terms_after"),
    )
