import hashlib
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.functions import vectors as vf
from furrow.operators import vector_index as vi
from furrow.plans import onboard
from furrow.plans.queries import retrieval
from furrow.settings import Settings
from furrow.sources.embedders import LexicalEmbedder, RemoteEmbedder, get_embedder

TEXTS = ["Spray the lentil", "spray  THE lentil", "ab", "", "टमाटर की खेती", "a" * 300]


def hashed(text, dim):
    norm = " ".join(text.lower().split())
    out = [0.0] * dim
    for i in range(max(len(norm) - 2, 0)):
        out[int.from_bytes(hashlib.blake2b(norm[i:i + 3].encode(), digest_size=4).digest(), "big") % dim] += 1
    size = math.sqrt(sum(v * v for v in out))
    return [v / size for v in out] if size else out


def test_lexical_vectors_equal_the_definition(spark, settings):
    e = LexicalEmbedder(settings)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    for r in e.embed_passages(df, "text", "v").collect():
        assert np.allclose(r["v"], hashed(r["text"], 64), atol=1e-6)
        assert np.allclose(r["v"], e.embed_query(r["text"]), atol=1e-6)
    assert e.token_column("text") is None and not e.semantic and "no model" in e.describe()


def test_native_grams_equal_slices(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for r in df.select("text", vf.grams("text").alias("g")).collect():
        norm = " ".join(r["text"].lower().split())
        assert (r["g"] or []) == [norm[i:i + 3] for i in range(len(norm) - 2)]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = [(f"p{i:03d}", [float(x) for x in v], f"t{i}", f"d{i % 4}", i, f"r{i % 5}", "en" if i % 2 else "hi", f"A{i % 3}", [f"A{(i + 1) % 3}"], i % 7 == 0)
            for i, v in enumerate(rng.normal(size=(200, 16)))]
    rows.append(("p999", [0.0] * 16, "zero", "d0", 999, "r0", "en", "A0", [], False))
    return spark.createDataFrame(rows, "point_id string, embedding array<float>, text string, document string, page int, resource_id string, "
                                       "language string, area_code string, also_area_codes array<string>, from_ocr boolean").persist()


def brute(points, q, keep):
    rows = [r for r in points.collect() if keep(r)]
    score = lambda r: float(np.dot(r["embedding"], q) / ((np.linalg.norm(r["embedding"]) or 1) * np.linalg.norm(q)))
    return [r["point_id"] for r in sorted(rows, key=lambda r: (-round(score(r), 9), r["point_id"]))][:5]


@pytest.mark.parametrize("scope, keep", [
    ({}, lambda r: True),
    ({"resource_ids": ["r1", "r3"]}, lambda r: r["resource_id"] in ("r1", "r3")),
    ({"area_code": "A1", "language": "en"}, lambda r: r["area_code"] == "A1" and r["language"] == "en"),
    ({"area_code": "A1", "also_areas": True}, lambda r: "A1" in [r["area_code"], *r["also_area_codes"]]),
    ({"resource_ids": []}, lambda r: False),
])
def test_top_k_equals_brute_force(points, scope, keep):
    q = [1.0 / (i + 1) for i in range(16)]
    got = [r["point_id"] for r in vi.top_k(vi.scoped(points, **scope), q).collect()]
    assert got == brute(points, q, keep)


def test_search_scoped_by_a_discovery_result(spark, points):
    class Fixed:
        semantic = False
        embed_query = staticmethod(lambda text: [1.0] * 16)

    ids = spark.createDataFrame([("r2",)], "resource_id string")
    hits = vi.search(points, Fixed(), "anything", limit=3, resource_ids=ids).collect()
    assert len(hits) == 3 and {h["resource_id"] for h in hits} == {"r2"}
    assert all(not h["semantic"] and h["citation"] == f"{h['document']} p.{h['page']}" for h in hits)
    assert vi.payload_of(points, "p005").columns.count("embedding") == 0 and vi.by_id(points, "p005").count() == 1


def test_upsert_is_idempotent_and_latest_wins(spark):
    held = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", 9)], "k string, v int")
    once = vi.upsert(held, new, ["k"], [F.desc("v")])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3), ("c", 9)]
    assert sorted(map(tuple, vi.upsert(once, new, ["k"], [F.desc("v")]).collect())) == [("a", 1), ("b", 3), ("c", 9)]


def passages(spark, n, document="d.pdf", word="lentil"):
    rows = [(f"{document}-{i}", f"{word} passage {i} " * 8, document, i) for i in range(n)]
    df = spark.createDataFrame(rows, "point_id string, text string, document string, page int")
    area = F.struct(F.lit("A").alias("code"), F.lit("Area").alias("name"), F.lit("State").alias("level"), F.lit("S").alias("scheme"))
    empty = F.array().cast("array<string>")
    return df.withColumns({
        "from_ocr": F.lit(False), "language": F.lit("en"), "category": F.lit("Crop"), "area": area,
        "also_covers": F.slice(F.array(area), 1, 0), "subjects": F.slice(F.array(F.struct(F.lit("u").alias("uri"))), 1, 0),
        "topics": empty, "weather_parameters": empty, "resource_id": F.lit("r")})


def test_index_reingest_replaces_and_prunes(spark, settings, tmp_path):
    table, e = str(tmp_path / "index"), LexicalEmbedder(settings)
    small = replace(settings, index_bucket_bytes=3000, page_chunk=2)
    assert onboard.index(spark, passages(spark, 6), e, table, small).count() == 6
    assert onboard.index(spark, passages(spark, 3, "other.pdf"), e, table, small).count() == 9
    again = onboard.index(spark, passages(spark, 6, word="tomato"), e, table, small)
    assert again.count() == 9 and again.where("document = 'd.pdf' and text like 'lentil%'").count() == 0
    fewer = onboard.index(spark, passages(spark, 2), e, table, small)
    assert fewer.count() == 9  # points of a shorter re-ingest stay
    pruned = onboard.index(spark, passages(spark, 2), e, table, small, pruned=True)
    assert pruned.where("document = 'd.pdf'").count() == 2 and pruned.count() == 5  # also those of page ranges not sent again
    assert onboard.index(spark, passages(spark, 2), e, table, small, fresh=True).count() == 2
    with pytest.raises(ValueError, match="fresh index"):
        onboard.index(spark, passages(spark, 2), LexicalEmbedder(replace(settings, embedding_dim=8)), table, small)


def test_an_older_row_that_arrives_late_changes_nothing(spark):
    held = spark.createDataFrame([("a", 5), ("b", 1), ("c", 2)], "k string, n int")
    late = spark.createDataFrame([("a", 3), ("b", 4), ("d", 9), ("b", 2)], "k string, n int")
    got = {r["k"]: r["n"] for r in vi.upsert(held, late, ["k"], [F.desc("n")]).collect()}
    assert got == {"a": 5, "b": 4, "c": 2, "d": 9}


def test_prune_drops_points_no_longer_sent(spark):
    held = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d2", "c")], "document string, point_id string")
    sent = spark.createDataFrame([("d1", "a")], "document string, point_id string")
    assert sorted(r["point_id"] for r in vi.prune(held, sent, "document", ["point_id"]).collect()) == ["a", "c"]


def test_backends_are_named_and_never_swapped(spark):
    with pytest.raises(ValueError, match="unknown embedding backend"):
        get_embedder(Settings(embedding_backend="magic"))
    with pytest.raises(RuntimeError, match="sentence-transformers"):
        get_embedder(Settings())
    with pytest.raises(ValueError, match="base_url"):
        get_embedder(Settings(embedding_backend="remote"))


def test_remote_backend_posts_batches_with_its_prefixes(spark):
    def fake_post(url, headers, body):
        assert url == "http://x/v1/embeddings" and headers == {"Authorization": "Bearer k"} and len(body["input"]) <= 2
        return {"data": [{"embedding": [3.0, 4.0] if t.startswith("passage: ") else [0.0, 2.0]} for t in body["input"]]}

    e = RemoteEmbedder(Settings(embedding_backend="remote", embedding_base_url="http://x/v1/", embedding_api_key="k",
                                embedding_dim=2, embedding_batch=2), fake_post)
    df = spark.createDataFrame([(str(i),) for i in range(7)], "text string")
    assert all(np.allclose(r["v"], [0.6, 0.8]) for r in e.embed_passages(df, "text", "v").collect())
    assert e.embed_query("q") == [0.0, 1.0]


def test_settings_from_environment():
    s = Settings.from_env({"FURROW_OCR_ENABLED": "yes", "FURROW_VISIBLE_TO": "a,b", "FURROW_MAX_PASSAGE_CHARS": "500"})
    assert s.ocr_enabled and s.visible_to == ("a", "b") and s.max_passage_chars == 500
    assert not Settings.from_env({}).ocr_enabled and "off" in Settings().describe()["ocr"]
    assert "no model" in Settings(embedding_backend="lexical").describe()["embeddings"]


def test_timing_claims_overlap_only_when_there_was_some():
    from furrow.operators.report import branch_timing

    assert branch_timing(1.0, 9.0, 9.0)["ran_in_parallel"] and not branch_timing(0.1, 9.0, 9.05)["ran_in_parallel"]


def test_a_search_reads_passages_of_all_that_discovery_matches(spark, monkeypatch):
    attributes = F.struct(F.array(F.struct(F.lit("XC").alias("areaCode"))).alias("coverageAreas"), F.array(F.lit("en")).alias("languages"),
                          F.lit("State").alias("geographicGranularity"))
    published = spark.range(1200).select(F.concat(F.lit("r"), "id").alias("resource_id"), F.lit("c").alias("catalog_id"),
                                         F.lit("p").alias("provider_id"), attributes.alias("attributes"))
    points = published.select(F.concat(F.lit("p"), "resource_id").alias("point_id"), "resource_id", F.lit("x").alias("text"),
                              F.lit("d").alias("document"), F.lit(1).alias("page"), F.lit("en").alias("language"), F.lit("XC").alias("area_code"),
                              F.array().cast("array<string>").alias("also_area_codes"), F.lit(False).alias("from_ocr"))
    sizes = []

    def search(points, *rest, resource_ids, **more):
        sizes.append(vi.scoped(points, resource_ids=resource_ids).count())
        return points.withColumns({"score": F.lit(0.0), "semantic": F.lit(False), "citation": F.lit("")})

    monkeypatch.setattr(retrieval.catalogue, "document_passages", lambda *a: points)
    monkeypatch.setattr(retrieval.catalogue, "published", lambda *a: published)
    monkeypatch.setattr(retrieval.vi, "embed", lambda points, embedder: points)
    monkeypatch.setattr(retrieval.vi, "search", search)
    retrieval.read_path(spark, "")
    assert sizes == [1200]


def test_gram_cells_count_where_texts_stand(spark, monkeypatch):
    """Counts by the definition, for repeated and null keys, wide characters and texts counted in pieces; only cells move."""
    texts = [*TEXTS, None, "a b  c", "x😀yz😀", "ab" * 40]
    want = {}
    for i, t in enumerate(texts):
        norm = " ".join((t or "").lower().split())
        for k in range(len(norm) - 2):
            at = (None if i == 1 else i % 4, int.from_bytes(hashlib.md5(norm[k:k + 3].encode()).digest()[:4], "big") % 64)
            want[at] = want.get(at, 0) + 1
    rows = spark.createDataFrame([(None if i == 1 else i % 4, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = vf.gram_cells(rows, "doc_id")
    assert {(r.doc_id, r.cell): r.n for r in got.collect()} == want
    md5 = lambda gram: hashlib.md5(gram).digest()
    whole = vf.GramCells(64, md5).counts([t or "" for t in texts])
    monkeypatch.setattr(vf.GramCells, "CHARS", 7)
    assert (vf.GramCells(64, md5).counts([t or "" for t in texts]) == whole).all() and whole.sum() > 300
