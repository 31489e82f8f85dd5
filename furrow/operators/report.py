"""Per-document extraction reports, token statistics and run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import script
from ..functions.text import token_count
from ..settings import Settings
from .pages import thin_counts, with_thin_warning


def _histogram(passages: DataFrame, column: str, as_: str) -> DataFrame:
    return (
        passages.groupBy("document", column).agg(F.count("*").alias("n"))
        .groupBy("document").agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(column), F.col("n"))))).alias(as_))
    )


def passage_summary(passages: DataFrame) -> DataFrame:
    """Counts per document, from flags; distinct districts are counted on
    (document, district) pairs combined map-side."""
    codes = F.concat(
        F.when(F.col("area.level") == "District", F.array("area.code")).otherwise(F.array().cast("array<string>")),
        F.transform(F.filter("also_covers", lambda a: a["level"] == "District"), lambda a: a["code"]),
    )
    flags = passages.select("document", (F.size("subjects") > 0).alias("subj"), F.array_distinct(codes).alias("codes"))
    counts = flags.groupBy("document").agg(
        F.count("*").alias("passages"),
        F.count_if("subj").alias("with_subject"),
        F.count_if(F.size("codes") > 0).alias("with_district"),
    )
    districts = (
        flags.select("document", F.explode("codes").alias("code")).distinct()
        .groupBy("document").agg(F.count("*").alias("districts"))
    )
    return counts.join(districts, "document", "left").withColumn(
        "districts", F.coalesce("districts", F.lit(0).cast("long")))


def page_summary(pages: DataFrame, settings: Settings) -> DataFrame:
    """Pages, characters, thin pages and encoding of each document, from counts
    made per page; page text is not read again."""
    counted = pages.withColumnRenamed("from_ocr", "ocr").groupBy("document").agg(
        F.count("*").alias("pages"), *thin_counts(settings),
        F.sum("script_chars").alias("_chars"), F.sum("marker_hits").alias("_hits"))
    return with_thin_warning(counted, settings).withColumn(
        "encoding", script.encoding(F.col("_chars"), F.col("_hits"))).drop("_chars", "_hits")


def extraction_report(pages: DataFrame, passages: DataFrame, settings: Settings) -> DataFrame:
    """One row per document, from segmented pages and their passages."""
    summary = passage_summary(passages)
    out = (
        page_summary(pages, settings)
        .join(summary, "document", "left")
        .join(_histogram(passages, "language", "languages"), "document", "left")
        .join(_histogram(passages, "category", "categories"), "document", "left")
        .na.fill(0, ["passages", "with_subject", "with_district", "districts"])
    )
    n = F.greatest(F.col("passages"), F.lit(1))
    out = out.withColumns({
        "subject_resolution": F.col("with_subject") / n,
        "district_resolution": F.col("with_district") / n,
    })
    return out.withColumn("warnings", warnings_of(settings))


def warnings_of(settings: Settings) -> Column:
    thin = (F.col("passages") > 0) & (F.col("subject_resolution") < settings.subject_warning_ratio)
    return F.array_compact(F.array(
        F.when(F.col("districts") == 0, F.lit("no district resolved: everything publishes at state level")),
        F.when(thin, F.format_string("only %d of %d passages resolved to a subject",
                                     F.col("with_subject"), F.col("passages"))),
        F.when(~F.col("encoding.healthy"), F.lit("text looks mis-encoded: lookups of affected words will fail")),
    ))


def token_report(texts: DataFrame, settings: Settings, tokens: Column | None = None) -> DataFrame:
    """Longest and mean token count, and how many texts exceed the window."""
    n = tokens if tokens is not None else token_count("text")
    return texts.agg(
        F.count("*").alias("passages"),
        F.coalesce(F.max(n), F.lit(0)).cast("long").alias("max_tokens"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("mean_tokens"),
        F.coalesce(F.count_if(n > settings.token_limit), F.lit(0)).alias("over_limit"),
    )


def run_totals(decisions: DataFrame, passages: DataFrame, resources: DataFrame) -> DataFrame:
    """One row: documents by outcome, passages, resources and published bytes.

    Each part is its own one-row aggregate, put together as scalar subqueries.
    """
    outcome = decisions.agg(
        F.count_if(F.col("status") == "ok").alias("onboarded"),
        F.count_if(F.col("status") == "refused").alias("refused"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    return outcome.withColumns({
        "passages": passages.agg(F.count("*")).scalar(),
        "resources": resources.agg(F.count("*")).scalar(),
        "attributes_bytes": resources.agg(
            F.coalesce(F.sum(F.octet_length(F.to_json("attributes"))), F.lit(0))).scalar(),
    })


def with_failures(decisions: DataFrame, summary: DataFrame) -> DataFrame:
    """A readable document without passages failed, and that is not a refusal."""
    joined = decisions.join(summary.select("document", "passages"), "document", "left")
    failed = (F.col("status") == "ok") & F.col("passages").isNull()
    return joined.withColumns({
        "status": F.when(failed, "failed").otherwise(F.col("status")),
        "reason": F.when(failed, F.lit("no passages extracted")).otherwise(F.col("reason")),
    }).drop("passages")


def branch_timing(catalogue_seconds: float, index_seconds: float, wall_seconds: float) -> dict:
    """What running both outputs at once bought. Only a wall clock clearly below
    the sum is evidence of overlap."""
    total = catalogue_seconds + index_seconds
    return {
        "catalogue_seconds": catalogue_seconds, "index_seconds": index_seconds, "wall_seconds": wall_seconds,
        "saved_seconds": total - wall_seconds, "ran_in_parallel": wall_seconds < total * 0.95,
        "ratio": index_seconds / max(catalogue_seconds, 1e-9),
    }
