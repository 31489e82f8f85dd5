"""Command line.

    python -m furrow.cli onboard --lexicon DIR [--file F ... | --all] [--fresh] [--ocr]
    python -m furrow.cli gaps --lexicon DIR [FILES ... | --all] [--limit N] [--json PATH]
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from .operators import discover as dc, gaps, report as rp, resources as res, vector_index
from .operators.lexicon import load_lexicon
from .plans import onboard, publish
from .session import build_session, run_folder, settle
from .settings import Settings
from .sources import ocr, readers, sinks
from .sources.embedders import get_embedder


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="furrow")
    sub = ap.add_subparsers(dest="command", required=True)
    both = argparse.ArgumentParser(add_help=False)
    both.add_argument("--lexicon", required=True, help="folder with crops, districts and capabilities")
    both.add_argument("--data", default="data", help="folder of the documents")
    both.add_argument("--all", action="store_true", help="every document of the folder")
    both.add_argument("--master", default=None)
    one = sub.add_parser("onboard", parents=[both])
    one.add_argument("--file", "--pdf", dest="files", action="append", default=[])
    one.add_argument("--out", default="out", help="folder of the index, the node table and the ledger")
    one.add_argument("--fresh", action="store_true", help="start the index anew")
    one.add_argument("--ocr", action="store_true", help="recover text from image pages")
    one.add_argument("--no-save", action="store_true", help="write no JSON files")
    one.add_argument("--show-resource", metavar="TEXT", help="print attributes of matching resources")
    one.add_argument("--query", default="", help="search to try at the end")
    one.add_argument("--probe", action="append", default=[], help="text that must not be published")
    two = sub.add_parser("gaps", parents=[both])
    two.add_argument("files", nargs="*")
    two.add_argument("--limit", type=int, default=30)
    two.add_argument("--json", metavar="PATH")
    return ap


def each_row(rows):
    """Rows one partition after the other: a listing of any length does not meet on the driver."""
    return rows.toLocalIterator(prefetchPartitions=True)


def run_onboard(args, spark, settings: Settings) -> int:
    settings = replace(settings, ocr_enabled=args.ocr or settings.ocr_enabled)
    for key, value in settings.describe().items():
        print(f"{key:12s} {value}")
    lexicon = load_lexicon(spark, args.lexicon, settings)
    embedder = get_embedder(settings)
    paths = [args.data] if args.all else readers.resolve_paths(args.files, args.data, [])
    documents = settle(readers.read_documents(spark, paths, root=args.data), "documents")
    engine = files = None
    if settings.ocr_enabled:
        ready, why = ocr.ocr_available()
        if ready:
            engine = ocr.tesseract_engine
            files = spark.read.format("binaryFile").load(paths).select(
                readers.document_column(args.data).alias("document"), "content")
        else:
            print(f"ocr          unavailable: {why}")
    got = onboard.extract(readers.pages_of(documents), lexicon, settings, refusals=readers.refusals_of(documents),
                          engine=engine, files=files)
    decisions = settle(got.decisions, "decisions")
    for r in each_row(decisions.where("status <> 'ok'").orderBy("document")):
        print(f"{r['status'].upper():8s} {r['document']}: {r['reason']}")
    for r in each_row(got.report.where(F.size("warnings") > 0).select("document", "warnings").orderBy("document")):
        print(f"WARNING  {r['document']}: " + "; ".join(r["warnings"]))
    if got.ocr is not None:
        for r in each_row(got.ocr.orderBy("document")):
            print("recovery     " + str(r.asDict()))
    totals = decisions.agg(F.count_if(F.col("status") == "ok").alias("ok"),
                           F.count_if(F.col("status") == "failed").alias("failed")).head()
    if not totals["ok"]:
        print("nothing was publishable")
        return 1
    unembedded = []
    resources, index, timing = onboard.both(spark, got, lexicon, settings, embedder, f"{args.out}/index", fresh=args.fresh,
                                            on_failure=unembedded.append)
    for failed in unembedded:
        for r in each_row(failed):
            print(f"{r['status'].upper():8s} {r['document']}: {r['reason']}")
    print(f"timing       catalogue {timing['catalogue_seconds']:.1f}s, index {timing['index_seconds']:.1f}s, wall {timing['wall_seconds']:.1f}s")
    tokens = embedder.token_column("text")
    if tokens is not None:
        print("tokens       " + str(rp.token_report(got.passages, settings, tokens).head().asDict()))
    result = publish.publish(spark, resources, lexicon, settings, table=f"{args.out}/node", ledger=f"{args.out}/ledger")
    changed = {None: "first recorded publish", True: "claims changed", False: "claims unchanged"}[result.changed]
    print(f"published    {result.status}, {result.resources} resources, {result.payload_bytes:,} bytes, {changed}")
    print(f"validation   {result.validation}")
    print(f"acknowledged {result.acknowledgement}")
    if result.problem_count:
        for r in each_row(result.problems):
            print(f"  {r['resource_id']}: {r['problem']}")
    if result.held is not None:
        print("facets       " + str(dc.facet_index(result.held).head().asDict()))
        leaked = dc.leaks(result.held, args.probe).where("resources > 0").collect() if args.probe else []
        if leaked:
            print(f"text reached the catalogue: {[r['probe'] for r in leaked]}")
            return 1
    if args.query:
        hits = vector_index.search(index, embedder, args.query, limit=3).collect()
        for h in hits:
            marks = ("" if h["semantic"] else " [spellings only]") + (" [from an image: verify doses]" if h["from_ocr"] else "")
            print(f"  {h['score']:.3f}  {h['citation']}  {h['resource_id']}{marks}")
        if not hits:
            print("the index gives no hits")
            return 1
    print("totals       " + str(rp.run_totals(decisions, got.passages, resources).head().asDict()))
    if args.show_resource:
        for r in dc.by_id_text(resources, args.show_resource).select("resource_id", F.to_json("attributes").alias("a")).toLocalIterator():
            print(r["resource_id"], r["a"])
    if not args.no_save:
        sinks.write_json(resources.select("catalog_id", "resource_id", "descriptor", "attributes"), f"{args.out}/resources", "catalog_id")
        sinks.write_json(result.envelope, f"{args.out}/payload")
        sinks.write_json(res.resource_documents(got.passages), f"{args.out}/resource-documents")
        sinks.write_json(decisions.where("status <> 'ok'"), f"{args.out}/refusals")
        own = onboard.catalogue(got, lexicon, settings, by_document=True)
        sinks.write_json(sinks.document_resources(own, got.report, lexicon, settings), f"{args.out}/documents", "document")
    return 1 if totals["failed"] else 0


def run_gaps(args, spark, settings: Settings) -> int:
    lexicon = load_lexicon(spark, args.lexicon, settings)
    paths = [args.data] if args.all or not args.files else readers.resolve_paths(args.files, args.data, [])
    documents = settle(readers.read_documents(spark, paths, root=args.data), "documents")
    for r in each_row(readers.refusals_of(documents)):
        print(f"SKIPPED  {r['document']}: {r['reason']}")
    pages = onboard.repaired_pages(readers.pages_of(documents), lexicon, settings)
    found = settle(gaps.occurrences(pages, lexicon), "gaps")
    cands = settle(gaps.candidates(found), "candidates")
    for title, rows in (("advisory lines", gaps.advisory_counts(pages, lexicon).orderBy("document")),
                        ("candidates", gaps.ranked(cands, args.limit).orderBy("document", "rank")),
                        ("across documents", gaps.across_documents(cands))):
        print(title)
        for r in each_row(rows):
            print("  " + "  ".join(f"{k}={v}" for k, v in r.asDict().items()))
    if args.json:
        sinks.write_json(cands.join(gaps.evidence(found), ["document", "term"]), args.json)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session("furrow", args.master)
    settings = Settings.from_env()
    with run_folder(spark):
        return run_onboard(args, spark, settings) if args.command == "onboard" else run_gaps(args, spark, settings)


if __name__ == "__main__":
    sys.exit(main())
