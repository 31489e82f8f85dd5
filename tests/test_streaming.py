from pyspark.sql import functions as F

from furrow.sources.embedders import LexicalEmbedder
from furrow.sources.manifest import read_table
from furrow.streaming.ingest import PAGES, ingest_pages, upsert_stream

PAD = " The field should be looked at again before the end of the week by whoever works on it."


def test_files_arrive_and_come_again(spark, lexicon, settings, make_pages, tmp_path):
    source, table, seen = str(tmp_path / "in"), str(tmp_path / "index"), []
    embedder = LexicalEmbedder(settings)

    def run():
        ingest_pages(spark, source, lexicon, settings, embedder, table=table, checkpoint=str(tmp_path / "cp"),
                     on_batch=lambda e, i: seen.append(e.passages.count())).awaitTermination()
        return read_table(spark, table)

    def send(documents):
        make_pages(documents).select(*[c.split()[0] for c in PAGES.split(", ")]).coalesce(1).write.mode("append").parquet(source)

    send({"alphaland_1.pdf": ["Alphaland. Lentil stands well." + PAD]})
    assert run().count() == 1
    send({"alphaland_1.pdf": ["Alphaland. Tomato stands well." + PAD], "alphaland_2.pdf": ["Alphaland. Onion." + PAD]})
    got = run()
    assert got.count() == 2 and got.where("text like '%Lentil%'").count() == 0 and seen == [1, 2]
    # the second page of a document comes later: its ordinal goes on, and the first page's state holds for it
    late = make_pages({"alphaland_1.pdf": ["", "Barley stands well, too." + PAD]}).where("page = 2")
    late.select(*[c.split()[0] for c in PAGES.split(", ")]).coalesce(1).write.mode("append").parquet(source)
    rows = sorted((r["page"], r["text"][:6]) for r in run().where("document = 'alphaland_1.pdf'").collect())
    assert rows == [(1, "Alphal"), (2, "Barley")] and seen == [1, 2, 2]


def test_keyed_stream_keeps_the_latest(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")
    for rows in ([("a", 1), ("b", 1), ("a", 2)], [("a", 3), ("c", 1), ("b", 0)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, v int").parquet(source)
        upsert_stream(stream, table, ["k"], [F.desc("v")], str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, read_table(spark, table).select("k", "v").collect())) == [("a", 3), ("b", 1), ("c", 1)]
