"""Facets of a passage: area, category, subjects, and the one canonical view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import script
from ..functions.text import point_id, resource_id, string_array, stripped_length
from ..settings import Settings
from . import sections
from .lexicon import Lexicon, with_mentions
from .ordered import running
from .segment import with_blocks


def category_of(slugs: Column, topics: Column, lexicon: Lexicon) -> Column:
    """An animal makes it livestock advice; crops make it horticulture when all
    are horticultural; a livestock topic comes next; the rest is weather."""
    livestock = string_array(sorted({e[3] for e in lexicon.rows("subject") if e[5] == "livestock"}))
    garden = string_array(sorted(lexicon.horticulture))
    return (
        F.when(F.arrays_overlap(slugs, livestock), "Livestock")
        .when((F.size(slugs) > 0) & (F.size(F.array_except(slugs, garden)) == 0), "Horticulture")
        .when(F.size(slugs) > 0, "Crop")
        .when(F.array_contains(topics, lexicon.livestock_topic), "Livestock")
        .otherwise("Weather")
    )


def choose_area(section: Column, mentioned: Column, state: Column) -> tuple[Column, Column]:
    """(primary code, further codes).

    Inside a section its first district is primary; else the only district
    named; else the state. All other districts are kept as coverage, first
    occurrence first.
    """
    empty = F.array().cast("array<string>")
    in_section = F.coalesce(F.size(section) > 0, F.lit(False))
    primary = (
        F.when(in_section, F.get(section, F.lit(0)))
        .when(F.size(mentioned) == 1, F.get(mentioned, F.lit(0)))
        .otherwise(state)
    )
    rest = (
        F.when(in_section, F.array_distinct(F.concat(F.slice(section, 2, F.greatest(F.size(section), F.lit(1))), mentioned)))
        .when(F.size(mentioned) == 1, empty)
        .otherwise(mentioned)
    )
    return primary, F.filter(rest, lambda code: code != primary)


def segmented(pages: DataFrame, lexicon: Lexicon, settings: Settings,
              rule: sections.HeadingRule = sections.HeadingRule()) -> DataFrame:
    """Pages cut into blocks, each page with the headings and counts that later
    steps need: the one pass over accepted page text.

    Input is `document, page, text, ocr, state_code`. The result is read several
    times and should be written (see `session.settle`).
    """
    state, text = F.col("state_code"), F.col("text")
    headed = pages.select(
        "document", "page", "state_code", F.col("ocr").alias("from_ocr"), "text",
        sections.page_heading(text, state, lexicon, rule).alias("_page_heading"),
        F.length(text).alias("chars"), stripped_length(text).alias("body_chars"),
        F.when(~text.rlike(script.DEVANAGARI), 0).otherwise(script.devanagari_chars(text)).alias("script_chars"),
        F.when(text.rlike(script.DEVANAGARI), script.marker_hits(text)).otherwise(0).alias("marker_hits"),
    )
    return with_blocks(headed, lexicon, settings).drop("text").withColumn(
        "_heads", F.transform("blocks", lambda b: sections.heading_areas(b, state, lexicon, rule))
    ).withColumns({
        "_leaves_with": F.coalesce(sections.last_heading(F.col("_heads")), F.col("_page_heading")),
        "_count": F.size("blocks").cast("long"),
    })


def placed(blocked: DataFrame, lexicon: Lexicon, settings: Settings, alias_table: DataFrame | None = None) -> DataFrame:
    """Passages with resolved facets, from `segmented` pages; see `resolve` for `alias_table`."""
    # Carried values come from a narrow copy, so that text is moved once at most, by the join, and not sorted.
    narrow = running(
        blocked.select("document", "page", "_leaves_with", "_count"), "document", "page", chunk=settings.page_chunk,
        fill={"_leaves_with": "_inherited"}, totals={"_count": "_before"}, inclusive=False,
    ).select("document", "page", "_inherited", "_before")
    carried = blocked.join(narrow, ["document", "page"])
    # The page's own last heading line replaces what it inherits, from the top.
    filled = sections.fill_blocks(F.col("_heads"))
    rows = carried.select(
        "document", "page", "state_code", "from_ocr", "_before",
        F.coalesce("_page_heading", "_inherited").alias("_top"),
        F.posexplode(F.arrays_zip(F.col("blocks").alias("text"), filled.alias("section"))).alias("_i", "b"),
    ).select(
        "document", "page", "state_code", "from_ocr",
        (F.col("_before") + F.col("_i")).alias("ordinal"),
        F.col("b.text").alias("text"),
        F.coalesce("b.section", "_top").alias("section"),
    )
    return resolve(rows, lexicon, settings, alias_table=alias_table)


def resolve(rows: DataFrame, lexicon: Lexicon, settings: Settings, language: Column | None = None,
            alias_table: DataFrame | None = None) -> DataFrame:
    """Facet columns for rows of `document, page, ordinal, text, section,
    state_code, from_ocr`. The language is detected unless a column tells it.
    With `alias_table`, the lexicon as a stored table, aliases are matched by join."""
    if alias_table is None:
        found = with_mentions(rows, lexicon, "text", "state_code")
    else:
        keyed = rows.withColumn("_passage", F.struct("document", "ordinal"))
        found = with_mentions(keyed, lexicon, "text", "state_code", by_join=("_passage", alias_table)).drop("_passage")
    primary, rest = choose_area(F.col("section"), F.col("district_codes"), F.col("state_code"))
    category = category_of(F.col("subject_slugs"), F.col("topics"), lexicon)
    empty = F.array().cast("array<string>")
    provider, domain = F.lit(settings.provider_id), F.lit(settings.domain)
    staged = found.withColumns({
        "_area": primary, "_also": rest, "category": category,
        "language": script.language("text", settings) if language is None else language,
    }).withColumns({
        # A forecast carries no crop claim and crop advice no forecast claim.
        "subject_slugs": F.when(F.col("category") == "Weather", empty).otherwise(F.col("subject_slugs")),
        "weather_parameters": F.when(F.col("category") == "Weather", F.col("weather_parameters")).otherwise(empty),
    })
    return staged.select(
        "document", "page", F.col("ordinal").cast("long").alias("ordinal"), "text", "language",
        F.transform("subject_slugs", lambda s: lexicon.subject_struct(s, settings)).alias("subjects"),
        lexicon.area_struct(F.col("_area"), settings).alias("area"),
        F.transform("_also", lambda c: lexicon.area_struct(c, settings)).alias("also_covers"),
        "category", "topics", "weather_parameters",
        resource_id(provider, domain, F.col("category"), F.col("_area")).alias("resource_id"),
        point_id(provider, F.col("document"), F.col("page"), F.col("ordinal")).alias("point_id"),
        F.coalesce("from_ocr", F.lit(False)).alias("from_ocr"), "state_code",
    )


def facet_columns() -> list[Column]:
    """The canonical facet view. The catalogue publishes it and the vector table
    stores it; both select this list, so they cannot drift apart."""
    return [
        F.col("language"), F.col("category"),
        F.col("area.code").alias("area_code"),
        F.col("area.level").alias("area_level"),
        F.col("area.name").alias("area_name"),
        F.col("also_covers.code").alias("also_area_codes"),
        F.col("subjects.uri").alias("subject_uris"),
        F.col("topics"), F.col("weather_parameters"), F.col("resource_id"),
    ]


def payload_columns() -> list[Column]:
    """What a vector carries besides its embedding."""
    return [F.col("text"), F.col("document"), F.col("page"), F.col("from_ocr"), *facet_columns()]


