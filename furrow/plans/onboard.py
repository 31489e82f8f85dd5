"""Onboard documents: pages to passages once, then the catalogue and the index.

The extraction result is written once and both outputs read it. Documents fail
one by one: a refusal or a failure is a row with a reason, never an exception
that costs the rest of the batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import script
from ..operators import facets, pages as pg, report as rp, resources as res, vector_index
from ..operators.lexicon import Lexicon
from ..operators.sections import HeadingRule
from ..session import evenly, settle
from ..settings import Settings
from ..sources import ocr as ocr_source
from ..sources.manifest import read_table, upsert_table


@dataclass
class Extraction:
    decisions: DataFrame   # one row per document: ok | refused | failed, reason
    pages: DataFrame       # accepted, repaired pages
    passages: DataFrame    # written table
    report: DataFrame      # one row per accepted document
    ocr: DataFrame | None  # one row per document, when recovery ran


def repaired_pages(pages: DataFrame, lexicon: Lexicon, settings: Settings, decisions: DataFrame | None = None) -> DataFrame:
    """All pages of readable documents, with the glyph repair where it helps. `decisions` spares working them out."""
    decisions = pg.repair_decisions(pages, lexicon, settings) if decisions is None else decisions
    decided = decisions.where("readable").select("document", "repair_applied")
    text = F.when(F.col("repair_applied"), script.repair_glyphs("text")).otherwise(F.col("text"))
    joined = pages.join(decided, "document")
    return joined.withColumn("text", text).drop("repair_applied")


def extract(pages: DataFrame, lexicon: Lexicon, settings: Settings, *, rule: HeadingRule = HeadingRule(),
            refusals: DataFrame | None = None, files: DataFrame | None = None, engine=None,
            alias_table: DataFrame | None = None, store=settle) -> Extraction:
    """`pages` is (document, page, text, ocr, has_image), tidied. `alias_table` has
    facets matched by join instead of expressions, with the same result.

    Order matters: repair comes before recovery, whose text is sound already,
    and recovery before the state is decided.

    Pages are written once, dealt out evenly whatever files they came in: what
    made their text is not worked out again for each use, and the long narrow
    steps that follow have as many tasks as the text deserves.
    """
    readings = None
    pages = store(evenly(pages), "pages")
    if engine is not None and files is not None:
        first = store(pg.repair_decisions(pages, lexicon, settings), "repairs")
        repaired = repaired_pages(pages, lexicon, settings, first)
        scored = store(ocr_source.augment(repaired, files, engine, lexicon, settings), "recovered")
        readings = pg.recovery_report(scored)
        usable = scored.select("document", "page", "text", "ocr", "has_image")
        decisions = pg.with_status(first.join(pg.state_of(usable, lexicon), "document", "left"))
        kept = decisions.where(F.col("status") == "ok").select("document", "state_code")
        accepted = usable.join(kept, "document")
    else:
        decisions = pg.document_decisions(pages, lexicon, settings, store)
        accepted = pg.apply_decisions(pages, decisions, settings)
    blocked = store(facets.segmented(accepted, lexicon, settings, rule), "blocks")
    found = store(facets.placed(blocked, lexicon, settings, alias_table), "passages")
    outcome = rp.with_failures(decisions, rp.passage_summary(found))
    if refusals is not None:
        outcome = outcome.unionByName(refusals, allowMissingColumns=True)
    return Extraction(outcome, accepted, found, rp.extraction_report(blocked, found, settings), readings)


def catalogue(extraction: Extraction, lexicon: Lexicon, settings: Settings, *,
              by_document: bool = False, store=settle) -> DataFrame:
    """Resources with attributes and descriptors."""
    rolled = res.rollup(extraction.passages, lexicon, settings, by_document)
    documents = None if by_document else res.resource_documents(extraction.passages)
    return store(res.attributes(rolled, documents, lexicon, settings), "resources")


def index(spark: SparkSession, passages: DataFrame, embedder, table: str, settings: Settings, *,
          fresh: bool = False, pruned: bool = False, on_failure: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Embed and upsert into the index table; re-ingest replaces by point id.

    A document with a passage that got no vector is left as the index holds it;
    `on_failure` gets these documents (document, status, reason).

    Buckets follow the document: a re-sent one touches its own bucket only, and
    `pruned` sees all points it had, whatever pages they were on. A bucket may be
    many files, so a very long document still is many tasks. The whole batch is
    one commit: a reader sees the index before it or after it.
    """
    held = None if fresh else read_table(spark, table)
    if held is not None:
        vector_index.check_dimension(held, embedder.dim)
    vectors, failed = vector_index.sound_documents(settle(vector_index.embed(passages, embedder), "vectors"))
    if on_failure:
        on_failure(failed)
    return upsert_table(vectors, table, ["point_id"], ["document"], fresh=fresh, pruned_by="document" if pruned else None,
                        written=True, sort_by=("resource_id", "language"), bucket_bytes=settings.index_bucket_bytes).read()


def both(spark: SparkSession, extraction: Extraction, lexicon: Lexicon, settings: Settings, embedder, table: str, *,
         fresh: bool = False, on_failure=None) -> tuple[DataFrame, DataFrame, dict]:
    """Catalogue and index side by side: two Spark jobs from two threads reading
    one passages table. Returns resources, index and the timing."""
    def timed(work):
        started = time.perf_counter()
        return work(), time.perf_counter() - started

    started = time.perf_counter()
    run = [copy_context(), copy_context()]  # both threads settle into this run's folder
    with ThreadPoolExecutor(2) as pool:
        a = pool.submit(run[0].run, timed, lambda: catalogue(extraction, lexicon, settings))
        b = pool.submit(run[1].run, timed, lambda: index(spark, extraction.passages, embedder, table, settings, fresh=fresh,
                                                         on_failure=on_failure))
        (resources, a_seconds), (vectors, b_seconds) = a.result(), b.result()
    return resources, vectors, rp.branch_timing(a_seconds, b_seconds, time.perf_counter() - started)
