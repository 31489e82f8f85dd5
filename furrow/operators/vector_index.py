"""The passage index: embedding, keyed upsert, and filtered exact top-k search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import citation
from ..functions.vectors import cosine_to
from .facets import payload_columns
from .ordered import first_per


def embed(passages: DataFrame, embedder) -> DataFrame:
    """One vector per passage with its payload, keyed by point id."""
    return embedder.embed_passages(passages.select("point_id", *payload_columns()), "text", "embedding")


def sound_documents(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors of the documents all of whose passages have one; and the other documents, as failures. `vectors` is a
    written table: embedding is not done twice."""
    failed = vectors.where(F.col("embedding").isNull()).groupBy("document").agg(
        F.lit("failed").alias("status"), F.format_string("%d passages without a vector", F.count("*")).alias("reason"))
    return vectors.join(failed, "document", "left_anti"), failed


def check_dimension(vectors: DataFrame, dim: int) -> None:
    """Refuse to mix vectors of two models: reads the dimension of one row."""
    row = vectors.select(F.size("embedding").alias("dim")).head()
    if row is not None and row["dim"] != dim:
        raise ValueError(
            f"the index holds {row['dim']}-d vectors and the embedder makes {dim}-d ones; "
            "start a fresh index instead of mixing them"
        )


def wrong_dimension(vectors: DataFrame, dim: int) -> DataFrame:
    return vectors.where(F.size("embedding") != dim)


def upsert(held: DataFrame, incoming: DataFrame, keys: list[str], newest_first: list[Column] | None = None) -> DataFrame:
    """Held and incoming rows, one for each key; nothing else is deleted.

    With `newest_first` the first in that order stays, whichever side it is of: an
    older row that arrives late changes nothing. Rows that tie there, and all rows
    without an order, go to the incoming side. The rank limit runs before the
    shuffle, so a hot key costs one row per task.
    """
    if newest_first:
        both = held.withColumn("_held", F.lit(1)).unionByName(
            incoming.select(*held.columns).withColumn("_held", F.lit(0)))
        return first_per(both, keys, [*newest_first, F.col("_held")]).drop("_held")
    latest = incoming.dropDuplicates(keys)
    kept = held.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*held.columns))


def prune(held: DataFrame, incoming: DataFrame, scope: str, keys: list[str]) -> DataFrame:
    """Held rows, without those of a re-sent scope that were not sent again."""
    stale = (
        held.join(incoming.select(scope).distinct(), scope, "left_semi")
        .join(incoming.select(*keys).distinct(), keys, "left_anti")
        .select(*keys)
    )
    return held.join(stale, keys, "left_anti")


def scoped(vectors: DataFrame, *, resource_ids=None, area_code: str | None = None, language: str | None = None,
           also_areas: bool = False) -> DataFrame:
    """Rows a search may return. `resource_ids` is a DataFrame or a list; None
    means unscoped, and an empty list means no rows at all."""
    rows = vectors
    if isinstance(resource_ids, DataFrame):
        rows = rows.join(resource_ids.select("resource_id").distinct(), "resource_id", "left_semi")
    elif resource_ids is not None:
        rows = rows.where(F.col("resource_id").isin(*resource_ids) if resource_ids else F.lit(False))
    if area_code:
        here = F.col("area_code") == area_code
        rows = rows.where(here | F.array_contains("also_area_codes", area_code) if also_areas else here)
    if language:
        rows = rows.where(F.col("language") == language)
    return rows


def top_k(vectors: DataFrame, query: list[float], *, id_col: str = "point_id", limit: int = 5,
          vector: str = "embedding") -> DataFrame:
    """Exact cosine top-k. Filters come before, so only rows in scope are scored;
    ties go to the lower id. Each task keeps `limit` rows, one merge follows."""
    return (
        vectors.withColumn("score", cosine_to(query)(F.col(vector)))
        .orderBy(F.desc("score"), id_col).limit(limit)
    )


def search(vectors: DataFrame, embedder, query: str, *, limit: int = 5, **scope) -> DataFrame:
    """Hits for a text query, each with its citation and whether the score
    compares meanings or only spellings."""
    hits = top_k(scoped(vectors, **scope), embedder.embed_query(query), limit=limit)
    return hits.select(
        "score", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("document", F.lit("")).alias("document"),
        F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("resource_id", F.lit("")).alias("resource_id"),
        F.coalesce("language", F.lit("")).alias("language"), F.lit(embedder.semantic).alias("semantic"),
        F.coalesce("from_ocr", F.lit(False)).alias("from_ocr"), citation("document", "page").alias("citation"),
    )


def by_id(vectors: DataFrame, point_id: str) -> DataFrame:
    return vectors.where(F.col("point_id") == point_id)


def payload_of(vectors: DataFrame, point_id: str) -> DataFrame:
    return by_id(vectors, point_id).drop("embedding")


def count(vectors: DataFrame) -> int:
    return vectors.count()
