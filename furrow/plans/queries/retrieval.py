"""Exact vector search, scoped and unscoped, and the index it runs on."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from ...functions import vectors as vf
from ...operators import discover as dc, vector_index as vi
from ...session import settle, shared_dir
from ...sources import manifest
from ...sources.embedders import LexicalEmbedder, RemoteEmbedder
from .. import onboard
from ..corpus import SETTINGS, table
from . import catalogue


def _query(e):
    """The vector of id 3: one row, read on the driver as a caller's query is."""
    return e.where("vec_id = 3").select("embedding").head()[0]


Q = "q as (select embedding::double[] as q from embeddings where vec_id = 3)"
COS = "round(list_cosine_similarity(embedding::double[], q), 6)"


def cosine_topk(spark, sf):
    e = table(spark, sf, "embeddings")
    return vi.top_k(e, _query(e), id_col="vec_id", limit=10).select("vec_id", F.round("score", 6).alias("score"))


TOPK_SQL = f"with {Q} select vec_id, {COS} as score from embeddings, q order by list_cosine_similarity(embedding::double[], q) desc, vec_id limit 10"


def cosine_topk_filtered(spark, sf):
    e = table(spark, sf, "embeddings")
    rows = e.withColumn("resource_id", F.col("label")).withColumn("language", F.when(F.col("label") < 5, "en"))
    scope = vi.scoped(rows, resource_ids=[1, 2, 5], language="en")
    return vi.top_k(scope, _query(e), id_col="vec_id", limit=10).select("vec_id", "label", F.round("score", 6).alias("score"))


FILTERED_SQL = f"""with {Q} select vec_id, label, {COS} as score from embeddings, q where label in (1, 2, 5) and label < 5
order by list_cosine_similarity(embedding::double[], q) desc, vec_id limit 10"""


def scoped_search(spark, sf):
    """Search inside what discovery returned: the three labels most seen."""
    e = table(spark, sf, "embeddings").withColumnRenamed("label", "resource_id")
    ids = e.groupBy("resource_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "resource_id").limit(3)
    return vi.top_k(vi.scoped(e, resource_ids=ids), _query(e), id_col="vec_id", limit=20).select(
        "vec_id", "resource_id", F.round("score", 6).alias("score"))


SCOPED_SQL = f"""with {Q}, ids as (select label from embeddings group by 1 order by count(*) desc, label limit 3)
select vec_id, label as resource_id, {COS} as score from embeddings, q where label in (select label from ids)
order by list_cosine_similarity(embedding::double[], q) desc, vec_id limit 20"""


def label_affinity(spark, sf):
    """Mean cosine of every vector to the query, by label: a full scan."""
    e = table(spark, sf, "embeddings")
    scored = e.withColumn("score", vf.cosine_to(_query(e))("embedding"))
    return scored.groupBy("label").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.count("*").alias("n"))


AFFINITY_SQL = f"with {Q} select label, round(avg(list_cosine_similarity(embedding::double[], q)), 6) as mean_score, count(*) as n from embeddings, q group by 1"


def unit_norms(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.size("embedding").alias("dim"), F.round(vf.norm("embedding"), 5).alias("norm"),
                    F.round(vf.norm(vf.unit("embedding")), 6).alias("unit_norm"))


NORM_SQL = """select vec_id, cast(len(embedding) as integer) as dim, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 5) as norm,
 1.0::double as unit_norm from embeddings"""


def dimension_check(spark, sf):
    return vi.wrong_dimension(table(spark, sf, "embeddings"), 32).select("vec_id")


DIMENSION_SQL = "select vec_id from embeddings where len(embedding) <> 32"


def point_lookup(spark, sf):
    """A point by its id, over points derived from documents."""
    points = table(spark, sf, "documents").select(
        F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("point_id"), "source", "n_chars")
    return vi.by_id(points, "p17")


LOOKUP_SQL = "select 'p' || doc_id as point_id, source, n_chars from documents where doc_id = 17"


def index_point_lookup(spark, sf):
    """Points of one document by their ids, over an index of many buckets: only the document's bucket is read."""
    folder, embedder = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", DigestEmbedder(SETTINGS)
    found = settle(catalogue.document_passages(spark, sf), "passages")
    onboard.index(spark, found, embedder, folder, replace(SETTINGS, index_bucket_bytes=200_000))
    asked = found.where("document = 'src3'").select("document", "point_id")
    now = manifest.open_table(spark, folder)
    held = now.read(now.buckets_with(asked, ["document"]))
    return held.join(asked.select("point_id"), "point_id", "left_semi").select("point_id", "document", "page", "category", "area_code")


INDEX_LOOKUP_SQL = f"""with {catalogue.ROWS} select {catalogue.sql.uuid5("'prov-corpus:' || document || ':' || page || ':' || ordinal")} as point_id,
 document, page, category, area_code from facets_ where document = 'src3'"""


def vector_points(spark, sf):
    """Embedded passages with their payload; checked for ids, dimension and norm."""
    points = vi.embed(catalogue.document_passages(spark, sf), LexicalEmbedder(SETTINGS))
    return points.select("point_id", F.size("embedding").alias("dim"), F.round(vf.norm("embedding"), 3).alias("norm"),
                         "document", "page", "category", "area_code")


POINTS_SQL = f"""with {catalogue.ROWS} select {catalogue.sql.uuid5("'prov-corpus:' || document || ':' || page || ':' || ordinal")} as point_id,
 64 as dim, case when length(text) < 3 then 0.0::double else 1.0::double end as norm, document, page, category, area_code from facets_"""


def md5(gram: bytes) -> bytes:
    return hashlib.md5(gram).digest()


class DigestEmbedder(LexicalEmbedder):
    """The lexical back end with a digest that SQL has too."""

    def __init__(self, settings):
        super().__init__(settings)
        self._embed = vf.lexical_embedder(self.dim, md5)


ASKED = "The erst of the thing"


def read_path(spark, sf):
    """Discover resources by area and language, then search the passages of what was found."""
    points = vi.embed(catalogue.document_passages(spark, sf), DigestEmbedder(SETTINGS))
    found = dc.discover(catalogue.published(spark, sf), area_code="XC", language="en", limit=None)
    hits = vi.search(points, DigestEmbedder(SETTINGS), ASKED, limit=25, resource_ids=found, area_code="XC", language="en",
                     also_areas=True)
    return hits.select(F.round("score", 5).alias("score"), "document", "page", "resource_id", "language", "semantic",
                       "from_ocr", "citation", F.length("text").alias("chars"))


def _cells(source: str, key: str) -> str:
    """Counts of the hashed grams of `t`."""
    return f"""select {key}, cast('0x' || substr(md5(g), 1, 8) as bigint) % 64 as cell, cast(count(*) as double) as n
 from (select {key}, substr(t, cast(i as bigint), 3) as g from (select {key}, t, unnest(range(1, length(t) - 1)) as i
 from (select {key}, trim(regexp_replace(lower(text), '[\\s\\x{{00A0}}]+', ' ', 'g')) as t from {source}))) group by 1, 2"""


READ_SQL = f"""with {catalogue.ROWS}, {catalogue.ROLLUP},
d_ as (select resource_id from r_ where list_contains(coverage, 'XC') and list_contains(string_split(languages, ','), 'en')),
p_ as (select * from facets_ where language = 'en' and (area_code = 'XC' or list_contains(also, 'XC'))
  and resource_id in (select resource_id from d_)),
c_ as ({_cells('p_', 'ordinal')}), a_ as (select 'q' as k, '{ASKED}' as text), q_ as ({_cells('a_', 'k')}),
s_ as (select c_.ordinal, sum(c_.n * coalesce(q_.n, 0)) / sqrt(sum(c_.n * c_.n)) / (select sqrt(sum(n * n)) from q_) as score
  from c_ left join q_ using (cell) group by 1)
select round(coalesce(score, 0), 5) as score, document, page, resource_id, language, false as semantic, false as from_ocr,
 document || ' p.' || page as citation, cast(length(text) as integer) as chars
from p_ left join s_ using (ordinal) order by coalesce(s_.score, 0) desc, ordinal limit 25"""


def index_reingest_pruned(spark, sf):
    """The index after documents came again with fewer pages: what they no longer have is gone, other points stay."""
    folder, embedder = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", DigestEmbedder(SETTINGS)
    found = settle(catalogue.document_passages(spark, sf), "passages")
    onboard.index(spark, found, embedder, folder, SETTINGS)
    shorter = found.where("document <> 'src1' and page % 3 = 0")
    return onboard.index(spark, shorter, embedder, folder, SETTINGS, pruned=True).select("point_id", "document", "page")


PRUNED_SQL = f"""with {catalogue.ROWS} select {catalogue.sql.uuid5("'prov-corpus:' || document || ':' || page || ':' || ordinal")} as point_id,
 document, page from facets_ where document = 'src1' or page % 3 = 0
 or document not in (select document from facets_ where page % 3 = 0)"""


def one_bad_text(url, headers, body):
    """An endpoint that cannot take texts under the Apache license."""
    if any("Apache" in t for t in body["input"]):
        raise ConnectionError("no answer")
    return {"data": [{"embedding": [float(len(t)), 1.0]} for t in body["input"]]}


def embedding_failures(spark, sf):
    """What becomes of each document when the endpoint fails for some texts: those documents fail, no others."""
    settings = replace(SETTINGS, embedding_base_url="http://endpoint.invalid", embedding_dim=2, publish_backoff_seconds=0.0)
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("document"), "text")
    vectors = settle(RemoteEmbedder(settings, one_bad_text).embed_passages(docs, "text", "embedding"), "vectors")
    sound, failed = vi.sound_documents(vectors)
    kept = sound.select("document", F.lit("ok").alias("status"), F.round(F.col("embedding")[0], 4).alias("value"))
    return kept.unionByName(failed.select("document", "status"), allowMissingColumns=True)


FAILURE_SQL = """select cast(doc_id as varchar) as document, 'failed' as status, cast(null as float) as value from documents
 where contains(text, 'Apache') union all
select cast(doc_id as varchar), 'ok', round(cast((length(text) + 9) / sqrt((length(text) + 9) ** 2 + 1) as float), 4) from documents
 where not contains(text, 'Apache')"""


def lexical_search(spark, sf):
    """Documents nearest in spelling to a benchmark item."""
    embedder = LexicalEmbedder(SETTINGS)
    item = table(spark, sf, "benchmark").orderBy("item_id").select("text").head()[0]
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("point_id"), "source", "text")
    points = embedder.embed_passages(docs, "text", "embedding")
    return vi.top_k(points, embedder.embed_query(item), limit=5).select("point_id", "source", F.round("score", 6).alias("score"))


QUERIES = {
    "cosine_topk": (cosine_topk, TOPK_SQL),
    "cosine_topk_filtered": (cosine_topk_filtered, FILTERED_SQL),
    "discovery_scoped_search": (scoped_search, SCOPED_SQL),
    "label_affinity": (label_affinity, AFFINITY_SQL),
    "unit_norms": (unit_norms, NORM_SQL),
    "dimension_check": (dimension_check, DIMENSION_SQL),
    "point_lookup": (point_lookup, LOOKUP_SQL),
    "index_point_lookup": (index_point_lookup, INDEX_LOOKUP_SQL),
    "vector_points": (vector_points, POINTS_SQL),
    "lexical_search": (lexical_search, None),
    "read_path": (read_path, READ_SQL),
    "index_reingest_pruned": (index_reingest_pruned, PRUNED_SQL),
    "embedding_failures": (embedding_failures, FAILURE_SQL),
}
