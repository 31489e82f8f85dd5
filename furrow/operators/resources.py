"""Passages rolled up into resources, and resources into catalogues.

A resource is one (area, category) of one provider. Its facet lists are built in
two steps: every (resource, facet, value) is counted first, combined map-side,
and only these distinct values, whose number the lexicon bounds, are gathered
into lists. Document names are the one unbounded facet; they are a table of
their own (`resource_documents`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import capability_of, catalog_id, schema_context, schema_context_ref, subject_code, wire_time
from ..settings import Settings
from .lexicon import Lexicon

# Cadence and horizon every resource declares.
UPDATE_FREQUENCY = "P1D"
FORECAST_HORIZON = "P7D"
WEATHER_TYPE = "WeatherAdvisoryCapability"
# How a category is described.
KIND_WORDS = (
    ("Crop", "Crop advisory"),
    ("Livestock", "Livestock advisory"),
    ("Horticulture", "Horticulture advisory"),
    ("Weather", "Weather forecast and warnings"),
)
# Wording of the published descriptions.
SHORT_FORMAT = "%s at %s granularity for %s"
LONG_FORMAT = (
    "%s advisory capability covering %s, standing on %s (source %s). Advisory text itself is "
    "served by the provider node on direct request, not through this catalogue."
)
CATALOG_NAME = "%s agromet advisory services"
CATALOG_SHORT = "Agromet advisories for %s"
CATALOG_LONG = (
    "District- and state-level agricultural, livestock and weather advisories for %s, derived "
    "from the agromet advisory bulletin series. Metadata only: this catalogue carries coverage "
    "and capability declarations, never advisory text."
)


def _tag(name: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value")))


def facet_counts(passages: DataFrame, by_document: bool = False) -> DataFrame:
    """Long form: resource, facet, value, passages with it, page span. Only numbers
    are combined, so Spark aggregates by hash.

    The `self` row of a resource holds its own totals. With `by_document` each
    document keeps its own resources, as when every document is published alone.
    """
    one = F.array(F.lit(""))
    tags = F.concat(
        _tag("self", one),
        _tag("subject", F.col("subjects.slug")),
        _tag("kind", F.col("subjects.kind")),
        _tag("topic", F.col("topics")),
        _tag("weather", F.col("weather_parameters")),
        _tag("also", F.col("also_covers.code")),
    )
    owner = F.col("document") if by_document else F.lit("")
    exploded = passages.select(
        owner.alias("owner"), "category", F.col("area.code").alias("area_code"), "resource_id", "page",
        F.explode(F.array_distinct(tags)).alias("t"),
    )
    return exploded.groupBy(
        "owner", "resource_id", "category", "area_code",
        F.col("t.facet").alias("facet"), F.col("t.value").alias("value"),
    ).agg(F.count("*").alias("n"), F.min("page").alias("page_min"), F.max("page").alias("page_max"))


def languages_by_frequency(passages: DataFrame, by_document: bool = False) -> DataFrame:
    """Languages of each resource, commonest first, ties by first appearance."""
    owner = F.col("document") if by_document else F.lit("")
    counted = passages.groupBy(owner.alias("owner"), "resource_id", "language").agg(
        F.count("*").alias("n"), F.min(F.struct("document", "ordinal")).alias("first"))
    rank = F.struct((-F.col("n")).alias("rank"), F.col("first").alias("at"), F.col("language").alias("v"))
    return counted.groupBy("owner", "resource_id").agg(
        F.transform(F.array_sort(F.collect_list(rank)), lambda x: x["v"]).alias("languages"))


def resource_documents(passages: DataFrame) -> DataFrame:
    """Every document behind every resource, with its passages: the full list,
    whatever its length."""
    return passages.groupBy("resource_id", "document").agg(F.count("*").alias("passages"))


def _values(facet: str, as_: str) -> Column:
    return F.array_sort(F.collect_set(F.when(F.col("facet") == facet, F.col("value")))).alias(as_)


def rollup(passages: DataFrame, lexicon: Lexicon, settings: Settings,
           by_document: bool = False) -> DataFrame:
    """One row per resource with sorted facet lists, in plain columns."""
    counts = facet_counts(passages, by_document)
    own = F.col("facet") == "self"
    rows = counts.groupBy("owner", "resource_id", "category", "area_code").agg(
        F.max(F.when(own, F.col("n"))).alias("passage_count"),
        F.max(F.when(own, F.col("page_min"))).alias("page_min"),
        F.max(F.when(own, F.col("page_max"))).alias("page_max"),
        _values("subject", "subject_slugs"), _values("kind", "_kinds"),
        _values("topic", "topics"), _values("weather", "weather_parameters"), _values("also", "_also"),
    ).join(languages_by_frequency(passages, by_document), ["owner", "resource_id"]).withColumns({
        "area": lexicon.area_struct(F.col("area_code"), settings),
        "state_code": lexicon.state_of_area(F.col("area_code")),
    })
    declared = F.array().cast("array<string>")
    cap_type, groups = F.lit(None).cast("string"), declared
    for c in lexicon.capabilities:
        here = F.col("category") == c.category
        declared = F.when(here, F.array(*map(F.lit, c.subject_categories))).otherwise(declared)
        groups = F.when(here, F.array(*map(F.lit, c.attribute_groups))).otherwise(groups)
        cap_type = F.when(here, c.type).otherwise(cap_type)
    present = F.transform("_kinds", lambda k: F.when(k == "crop", "Crop").otherwise("Livestock"))
    coverage = F.concat(F.array("area_code"), F.filter("_also", lambda c: c != F.col("area_code")))
    return rows.withColumns({
        "capability": cap_type,
        "groups": groups,
        "subject_categories": F.array_sort(F.array_union(declared, present)),
        "coverage_codes": coverage,
        "catalog_id": catalog_id(F.lit(settings.provider_id), F.lit(settings.domain), F.col("state_code")),
    }).drop("_kinds", "_also")


def _listed(values: Column) -> Column:
    """A list that is left out when it is empty."""
    return F.when(F.size(values) > 0, values)


def attributes(resources: DataFrame, documents: DataFrame | None, lexicon: Lexicon,
               settings: Settings) -> DataFrame:
    """Add the nested `attributes` and `descriptor` of each resource.

    `documents` is `resource_documents`; null means one document per resource,
    named by `owner`. A resource of several documents says how many there are,
    and the table published beside the catalogue names them all: their number
    has no bound, so the shape does not depend on it.
    """
    if documents is None:
        rows = resources.withColumns({
            "document_count": F.lit(1).cast("long"), "source_documents": F.array("owner")})
    else:
        counted = documents.groupBy("resource_id").agg(F.count("*").alias("document_count"))
        rows = resources.join(counted, "resource_id").withColumn(
            "source_documents", F.lit(None).cast("array<string>"))

    def area(code: Column) -> Column:
        a = lexicon.area_struct(code, settings)
        return F.struct(
            a["scheme"].alias("codeScheme"), a["code"].alias("areaCode"),
            a["level"].alias("areaLevel"), a["name"].alias("areaName"))

    def subject(slug: Column) -> Column:
        s = lexicon.subject_struct(slug, settings)
        return F.struct(
            s["uri"].alias("subjectId"),
            F.when(s["kind"] == "crop", "Crop").otherwise("Livestock").alias("subjectType"),
            F.struct(subject_code(slug).alias("code"), s["name"].alias("name")).alias("descriptor"))

    def gated(group: str, values: Column) -> Column:
        return F.when(F.array_contains("groups", group), _listed(values))

    # Subjects are listed by URI, which begins with the kind.
    subjects = F.array_sort(F.transform("subject_slugs", subject))
    attrs = F.struct(
        schema_context(F.col("capability"), settings).alias("@context"),
        F.concat(F.lit(settings.type_prefix + ":"), F.col("capability")).alias("@type"),
        F.col("subject_categories").alias("subjectCategories"),
        F.col("languages"),
        F.transform("coverage_codes", area).alias("coverageAreas"),
        F.col("area.level").alias("geographicGranularity"),
        gated("agricultureSubjects", subjects).alias("agricultureSubjects"),
        gated("weatherParameters", F.col("weather_parameters")).alias("weatherParameters"),
        gated("topics", F.col("topics")).alias("topics"),
        F.struct(
            F.col("source_documents").alias("sourceDocuments"),
            F.col("document_count").alias("documentCount"),
            F.col("passage_count").alias("passageCount"),
            F.array("page_min", "page_max").alias("pageRange"),
        ).alias("evidence"),
        F.lit(UPDATE_FREQUENCY).alias("updateFrequency"),
        F.when(F.col("capability") == WEATHER_TYPE, FORECAST_HORIZON).alias("forecastHorizon"),
    )
    return rows.withColumns({"attributes": attrs, "descriptor": descriptor()})


def short_description(category: Column, level: Column, name: Column) -> Column:
    kind = category
    for value, words in KIND_WORDS:
        kind = F.when(category == value, words).otherwise(kind)
    return F.format_string(SHORT_FORMAT, kind, F.lower(level), name)


def long_description(category: Column, name: Column, n: Column, lo: Column, hi: Column) -> Column:
    pages = F.when(lo == hi, F.format_string("page %s", lo.cast("string"))).otherwise(
        F.format_string("pages %s-%s", lo.cast("string"), hi.cast("string")))
    held = F.when(n == 1, F.lit("1 indexed passage")).otherwise(F.format_string("%d indexed passages", n))
    return F.format_string(LONG_FORMAT, category, name, held, pages)


def descriptor() -> Column:
    name, level = F.col("area.name"), F.col("area.level")
    return F.struct(
        F.concat(F.upper("category"), F.lit("-"), F.col("area_code")).alias("code"),
        F.concat(F.col("category"), F.lit(" advisory, "), name).alias("name"),
        short_description(F.col("category"), level, name).alias("shortDesc"),
        long_description(F.col("category"), name, F.col("passage_count"), F.col("page_min"),
                         F.col("page_max")).alias("longDesc"),
    )


def catalogs(resources: DataFrame, lexicon: Lexicon, settings: Settings, now: Column) -> DataFrame:
    """One row per catalogue. Its resources are at most areas x categories of
    the lexicon (times documents when published per document)."""
    names = lexicon.area_struct(F.col("state_code"), settings)["name"]
    return (
        resources.groupBy("owner", "catalog_id", "state_code")
        .agg(F.array_sort(F.collect_list(F.struct(
            "area_code", "category",
            F.struct(F.col("resource_id").alias("id"), "descriptor",
                     F.col("attributes").alias("resourceAttributes")).alias("r"),
        ))).alias("_members"))
        .withColumn("state_name", names)
        .select(
            "owner", "catalog_id", "state_code",
            F.struct(
                F.col("catalog_id").alias("id"),
                F.struct(
                    F.concat(F.lit(settings.provider_code + "-"), F.col("state_code")).alias("code"),
                    F.format_string(CATALOG_NAME, "state_name").alias("name"),
                    F.format_string(CATALOG_SHORT, "state_name").alias("shortDesc"),
                    F.format_string(CATALOG_LONG, "state_name").alias("longDesc"),
                ).alias("descriptor"),
                F.struct(
                    F.lit(settings.provider_id).alias("id"),
                    F.struct(F.lit(settings.provider_code).alias("code"),
                             F.lit(settings.provider_name).alias("name")).alias("descriptor"),
                ).alias("provider"),
                F.lit(True).alias("isActive"),
                F.struct(
                    wire_time(now).alias("startDate"),
                    wire_time(now + F.make_dt_interval(F.lit(settings.validity_days))).alias("endDate"),
                ).alias("validity"),
                F.transform("_members", lambda m: m["r"]).alias("resources"),
            ).alias("catalog"),
        )
    )


def envelope(catalog_rows: DataFrame, settings: Settings, *, transaction_id: str, message_id: str,
             now: Column) -> DataFrame:
    """Publish bodies, one per owner: a single one when resources are rolled up
    across documents, else one per document. A body holds at most one catalogue
    per state of the lexicon."""
    types = F.flatten(F.collect_list(F.transform(
        "catalog.resources", lambda r: capability_of(r["resourceAttributes"]["@type"]))))
    refs = F.transform(F.array_sort(F.array_distinct(types)), lambda t: schema_context_ref(t, settings))
    visible = F.array(*map(F.lit, settings.visible_to)).cast("array<string>")
    own_message = F.when(F.col("owner") == "", F.lit(message_id)).otherwise(
        F.concat_ws(":", F.lit(message_id), F.col("owner")))
    return catalog_rows.groupBy("owner").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("catalog_id", "catalog"))),
                    lambda m: m["catalog"]).alias("_catalogs"),
        refs.alias("_refs"),
    ).select(
        F.struct(
            F.lit(settings.domain).alias("domain"), F.lit("publish").alias("action"),
            F.lit(settings.envelope_version).alias("version"),
            F.lit(transaction_id).alias("transactionId"), own_message.alias("messageId"),
            wire_time(now).alias("timestamp"),
            F.col("_refs").alias("schemaContext"),
        ).alias("context"),
        F.struct(
            F.col("_catalogs").alias("catalogs"),
            F.transform("_catalogs", lambda c: F.struct(
                c["id"].alias("catalogId"), F.lit(settings.catalog_type).alias("catalogType"),
                visible.alias("visibleTo"),
            )).alias("publishDirectives"),
        ).alias("message"),
    )


def capability_counts(resources: DataFrame) -> DataFrame:
    return resources.groupBy("capability").agg(F.count("*").alias("resources"))


def schema_contexts(resources: DataFrame, settings: Settings) -> DataFrame:
    """Distinct schema addresses of all capability types present."""
    return resources.select(schema_context_ref(F.col("capability"), settings).alias("schema_context")).distinct()


def id_drift(passages: DataFrame, resources: DataFrame) -> DataFrame:
    """Ids on one side only; empty when both outputs agree."""
    left = passages.select("resource_id").distinct()
    right = resources.select("resource_id").distinct()
    return left.join(right, "resource_id", "left_anti").withColumn("only_in", F.lit("passages")).unionByName(
        right.join(left, "resource_id", "left_anti").withColumn("only_in", F.lit("resources")))
