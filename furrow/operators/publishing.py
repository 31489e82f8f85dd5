"""What is claimed, when it changed, and what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import Settings
from .ordered import first_per, running
from .vector_index import prune, upsert


def published_rows(resources: DataFrame, settings: Settings) -> DataFrame:
    """Resources as the node holds them: attributes and owner, never text."""
    return resources.where(F.col("attributes").isNotNull()).select(
        "resource_id", "catalog_id", F.lit(settings.provider_id).alias("provider_id"), "attributes", "state_code")


def publish_into(held: DataFrame, resources: DataFrame, settings: Settings, *, pruned: bool = False) -> DataFrame:
    """Upsert by resource id. Resources missing from this publish stay, unless
    `pruned` drops those of the catalogues that were sent. Published document by
    document, the same resource may come twice: the last document's is held."""
    last_first = [F.desc("owner")] if "owner" in resources.columns else [F.desc("catalog_id")]
    incoming = published_rows(first_per(resources, ["resource_id"], last_first), settings)
    base = prune(held, incoming, "catalog_id", ["resource_id"]) if pruned else held
    return upsert(base, incoming, ["resource_id"])


def json_bytes(value: Column) -> Column:
    """UTF-8 size of the compact JSON form."""
    return F.octet_length(F.to_json(value))


def acknowledgement(held: DataFrame, resources: DataFrame) -> DataFrame:
    """ACCEPTED, with counts and the bytes of attributes held."""
    return held.agg(
        F.coalesce(F.sum(json_bytes(F.col("attributes"))), F.lit(0)).cast("long").alias("attributes_bytes"),
    ).select(
        F.lit("ACCEPTED").alias("status"),
        resources.agg(F.array_sort(F.collect_set("catalog_id"))).scalar().alias("catalog_ids"),
        resources.agg(F.count_if(F.col("attributes").isNotNull())).scalar().alias("resources_indexed"),
        "attributes_bytes",
    )


def fold_statuses(results: DataFrame, *keys: str, status: str = "status") -> DataFrame:
    """One status per publish: the common one, PARTIAL when they differ."""
    return results.groupBy(*keys).agg(
        F.when(F.count(status) == 0, "ACCEPTED")
        .when(F.min(status) != F.max(status), "PARTIAL")
        .otherwise(F.min(status)).alias("status"))


LANES = 4
_HEX_PER_LANE = 15


def lanes(digest: Column) -> dict[str, Column]:
    """A SHA-256 digest in hex as four whole numbers, which can be summed."""
    return {f"l{i}": F.conv(F.substring(digest, 1 + i * _HEX_PER_LANE, _HEX_PER_LANE), 16, 10).cast("decimal(38,0)")
            for i in range(LANES)}


def lane_sums(rows: DataFrame, digest: Column, *keys: str) -> DataFrame:
    """The state behind a claims hash: number of rows and sum of each lane, for each value of the keys. States of
    different rows add up."""
    return rows.withColumns(lanes(digest)).groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(f"l{i}").cast("decimal(38,0)").alias(f"l{i}") for i in range(LANES)])


def hash_of(sums: DataFrame) -> DataFrame:
    """`lane_sums` with the hash in their place."""
    names = ["n", *(f"l{i}" for i in range(LANES))]
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in names])
    return sums.withColumn("claims_hash", F.sha2(text, 256)).drop(*names)


def claims_hash(rows: DataFrame, body: Column, *keys: str) -> DataFrame:
    """A digest of a set of rows that does not depend on their order.

    Each row's SHA-256 is cut into four 60-bit lanes, and lanes are summed: a
    partial aggregate of four numbers, so a catalogue of any size is never
    gathered into one string. The sums and the row count are hashed at the end.
    `history.moved_sums` keeps the sums up to date without the rows that stay.
    """
    return hash_of(lane_sums(rows, F.sha2(body, 256), *keys))


def resource_claims(resources: DataFrame, *keys: str) -> DataFrame:
    """Digest of published claims; run ids, time stamps and validity are no part
    of a resource, so an unchanged republish keeps it."""
    body = F.to_json(F.struct("catalog_id", "resource_id", "descriptor", "attributes"))
    return claims_hash(resources, body, *keys)


def mark_changes(ledger: DataFrame, target: str, value: str = "claims_hash", order: str = "seq",
                 chunk: int = 1024) -> DataFrame:
    """Did each entry differ from the one before it of the same target? Null for
    the first. (target, order) is unique and order is integral; a target of any
    length is spread over tasks."""
    seen = running(ledger, target, order, chunk=chunk, fill={value: "_before"}, inclusive=False)
    return seen.withColumn("changed_since_previous", F.col(value) != F.col("_before")).drop("_before")


def retain(ledger: DataFrame, settings: Settings, order: str = "seq") -> DataFrame:
    """The newest entries, as a top-k."""
    return ledger.orderBy(F.desc(order)).limit(settings.ledger_limit)
