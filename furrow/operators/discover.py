"""Discovery over published attributes: facet filters, score, facet counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import capability_of

# What a match on each facet adds to the score.
SUBJECT, AREA, LANGUAGE, CAPABILITY, DISTRICT = 2, 2, 1, 1, 1


def discover(published: DataFrame, *, subject_uri: str | None = None, area_code: str | None = None,
             language: str | None = None, capability: str | None = None, limit: int | None = 5) -> DataFrame:
    """Top matches by (-score, id). Given facets must all match; a district
    resource outranks a statewide one. Sorting is a top-k, not a full sort;
    with None as the limit all matches come, unsorted, as a search's scope."""
    a = F.col("attributes")
    areas = F.transform(a["coverageAreas"], lambda x: x["areaCode"])
    wanted: list[tuple[str, int, Column]] = []
    if subject_uri:
        wanted.append(("subject", SUBJECT, F.exists(a["agricultureSubjects"], lambda s: s["subjectId"] == subject_uri)))
    if area_code:
        wanted.append(("area", AREA, F.array_contains(areas, area_code)))
    if language:
        wanted.append(("language", LANGUAGE, F.array_contains(a["languages"], language)))
    if capability:
        wanted.append(("capability", CAPABILITY, capability_of(a["@type"]) == capability))
    rows = published
    for _, _, test in wanted:
        rows = rows.where(test)
    points = sum(p for _, p, _ in wanted)
    score = F.lit(points) + F.when(a["geographicGranularity"] == "District", DISTRICT).otherwise(0)
    matched = F.array(*[F.lit(n) for n, _, _ in wanted]).cast("array<string>")
    found = rows.select(
        "resource_id", "catalog_id", "provider_id", score.cast("int").alias("score"),
        matched.alias("matched_on"), a["languages"].alias("languages"),
        F.filter(areas, lambda x: x.isNotNull() & (x != "")).alias("area_codes"),
    )
    return found if limit is None else found.orderBy(F.desc("score"), "resource_id").limit(limit)


FACETS = ("subject_uris", "area_codes", "topics", "subject_categories", "weather_parameters", "languages")


def facet_values(published: DataFrame) -> DataFrame:
    """(facet, value), once for each resource that has it."""
    a = F.col("attributes")
    nothing = F.array().cast("array<string>")
    present = lambda values: F.filter(values, lambda v: v.isNotNull() & (v != ""))
    values = (present(F.transform(a["agricultureSubjects"], lambda s: s["subjectId"])),
              present(F.transform(a["coverageAreas"], lambda s: s["areaCode"])),
              a["topics"], a["subjectCategories"], a["weatherParameters"], a["languages"])

    def tagged(facet: str, listed: Column) -> Column:
        return F.transform(F.array_distinct(F.coalesce(listed, nothing)),
                           lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))

    return published.select(F.explode(F.concat(*map(tagged, FACETS, values))).alias("p")).select("p.facet", "p.value")


def facet_index(published: DataFrame) -> DataFrame:
    """Rows and distinct values of each facet.

    Every (facet, value) pair is made distinct map-side, then counted; no list
    is gathered.
    """
    pairs = facet_values(published).distinct()
    counts = pairs.groupBy().agg(*[F.count_if(F.col("facet") == f).alias(f) for f in FACETS])
    return counts.withColumn("resources", published.agg(F.count("*")).scalar())


def facet_counts(published: DataFrame) -> DataFrame:
    """(facet, value, resources): how many resources have each value, and under the facet `resources` how many there
    are. Counts of different resources add up, so they are kept by `history.moved_counts` without a scan."""
    whole = published.select(F.lit("resources").alias("facet"), F.lit("").alias("value"))
    return facet_values(published).unionByName(whole).groupBy("facet", "value").agg(F.count("*").alias("resources"))


def facet_index_of(counts: DataFrame) -> DataFrame:
    """The facet index from `facet_counts`."""
    held = F.col("resources") > 0
    return counts.groupBy().agg(*[F.count_if((F.col("facet") == f) & held).alias(f) for f in FACETS],
                                F.coalesce(F.sum(F.when(F.col("facet") == "resources", F.col("resources"))), F.lit(0)).alias("resources"))


def leaks(published: DataFrame, probes: list[str]) -> DataFrame:
    """Per probe, in how many resources it stands, whatever the case."""
    body = F.lower(F.to_json("attributes"))
    flags = published.select(*[F.contains(body, F.lit(p.lower())).alias(f"p{i}") for i, p in enumerate(probes)])
    counted = flags.agg(*[F.count_if(F.col(f"p{i}")).alias(f"p{i}") for i in range(len(probes))])
    stacked = ", ".join(f"{i}, p{i}" for i in range(len(probes)))
    return counted.selectExpr(f"stack({len(probes)}, {stacked}) as (probe, resources)").select(
        F.get(F.array(*map(F.lit, probes)), "probe").alias("probe"), "resources")


def contains_text(texts: DataFrame, needle: str, body: str = "text") -> DataFrame:
    """Rows whose text holds the needle, whatever the case."""
    return texts.where(F.contains(F.lower(body), F.lit(needle.lower())))


def round_trip(sent: DataFrame, held: DataFrame, key: str = "resource_id", value: str = "attributes") -> DataFrame:
    """Sent values that are missing or different on the other side."""
    s = sent.select(F.col(key), F.to_json(F.struct(value)).alias("_sent"))
    h = held.select(F.col(key), F.to_json(F.struct(value)).alias("_held"), F.lit(True).alias("_here"))
    problem = F.when(F.col("_here").isNull(), "not held").when(F.col("_sent") != F.col("_held"), "differs")
    return s.join(h, key, "left").select(key, problem.alias("problem")).where(F.col("problem").isNotNull())


def by_id_text(resources: DataFrame, needle: str) -> DataFrame:
    return resources.where(F.contains(F.lower("resource_id"), F.lit(needle.lower())))
