"""Onboarding as files arrive.

Re-ingest is idempotent: ids are functions of content position, so a micro-batch
that runs again after a failure replaces what it wrote. The batch plan is the
same one; only the trigger differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.lexicon import Lexicon
from ..operators.sections import HeadingRule
from ..plans import onboard
from ..session import run_folder, settle
from ..settings import Settings
from ..sources.manifest import BUCKET_BYTES, upsert_table

PAGES = "document string, page int, text string, ocr boolean, has_image boolean"


def ingest_pages(spark: SparkSession, source: str, lexicon: Lexicon, settings: Settings, embedder, *,
                 table: str, checkpoint: str, rule: HeadingRule = HeadingRule(),
                 on_batch=None) -> StreamingQuery:
    """Follow a folder of page files (parquet). Pages of a document may come in
    any number of batches: they are kept in a table beside the index, and each
    micro-batch derives the documents it touches anew from all their pages.
    `on_batch(extraction, batch_id)` lets a caller publish the catalogue too."""
    stream = spark.readStream.schema(PAGES).parquet(source)

    def one(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        session = batch.sparkSession
        with run_folder(session):
            arrived = settle(batch, "arrived")
            kept = upsert_table(arrived, f"{table}-pages", ["document", "page"], ["document"], written=True,
                                bucket_bytes=settings.index_bucket_bytes)
            # a document is in one bucket, so only buckets with news are read
            names = arrived.select("document").distinct()
            pages = kept.read(kept.buckets_with(names, ["document"])).join(names, "document", "left_semi")
            extraction = onboard.extract(settle(pages, "pages"), lexicon, settings, rule=rule)
            onboard.index(session, extraction.passages, embedder, table, settings, pruned=True)
            if on_batch:
                on_batch(extraction, batch_id)

    return (
        stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def upsert_stream(stream: DataFrame, table: str, keys: list[str], newest_first: list, checkpoint: str,
                  bucket_bytes: int = BUCKET_BYTES) -> StreamingQuery:
    """Keyed latest-wins upsert of any stream into a table of commits: a micro-batch
    rewrites the buckets its keys fall into."""
    def one(batch: DataFrame, batch_id: int) -> None:
        with run_folder(batch.sparkSession):
            upsert_table(batch, table, keys, keys, newest_first=newest_first, bucket_bytes=bucket_bytes)

    return (
        stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
