"""A content-addressed web archive: payload bytes once, exact record headers apart, records rebuilt by joins.

`write_archive` makes two tables in a folder of its own:

* `payloads` (digest, sha256, length, payload): the bytes of each distinct payload, keyed by its SHA-1 in base 32
  together with its SHA-256 and length, so that equal keys mean equal bytes (verified, not assumed);
* `records` (page_id, digest, sha256, length, kind, header, odd_url): the exact header of each record, up to its empty
  line; `odd_url` is the url as it came where the header has codes in it, and null elsewhere.

`read_archive` rebuilds every record: a response is its header, the payload and two line ends; a revisit has no block
of its own and refers to its response, whose payload gives its full content.

Of records with equal payloads of at least `least` bytes, the one with the largest page id is the response; smaller
payloads are always responses. Defined cases: a null html is an empty payload, a null url leaves the target header
out, control characters in a url become their percent codes (`url` of the rebuilt records has them as they came); null page ids become records without page id, which
sort below every page id; rows that repeat a page id and payload are one response and further revisits of it; an
empty table gives an empty archive. Extra columns are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.session import settle, shared_dir

#: The alphabet of base 32 (RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
#: The control characters of ASCII.
CONTROL = (*range(32), 127)


def base32_of_sha1(hexed: Column) -> Column:
    """160 bits as 32 letters: four letters for every five hexadecimal digits."""
    letters = []
    for group in range(8):
        value = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, 5 * k).bitwiseAND(31) + 1, F.lit(1))
                    for k in (3, 2, 1, 0)]
    return F.concat(*letters)


def digested(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (pages.select("page_id", "url", payload.alias("payload"))
            .select("page_id", "url", "payload", base32_of_sha1(F.sha1("payload")).alias("digest"),
                    F.sha2("payload", 256).alias("sha256"), F.length("payload").cast("long").alias("length")))


def record_name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def headers(rows: DataFrame) -> DataFrame:
    """Exact header text from page_id, url, digest, length, kind and refers_to."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("kind") == "revisit"
    coded = F.col("url")
    for code in CONTROL:
        coded = F.replace(coded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.when(F.col("url").rlike(r"\p{Cntrl}"), coded).otherwise(F.col("url"))
    return rows.withColumn("header", F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", record_name(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", record_name(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("length")).cast("string")),
        F.lit("\r\n")))


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write both tables. Html crosses the network once, each payload at most once per task; all else is narrow."""
    rows = digested(pages)
    key = ["digest", "sha256", "length"]
    # equal keys mean equal bytes, so any row's payload will do; copies are dropped before the exchange
    rows.groupBy(*key).agg(F.first("payload").alias("payload")).write.parquet(f"{folder}/payloads")
    narrow = settle(rows.drop("payload"), "digests")
    chosen = narrow.groupBy(*key).agg(F.max("page_id").alias("refers_to"))
    marked = narrow.join(chosen, key)
    is_chosen = F.col("page_id").eqNullSafe(F.col("refers_to"))
    # several rows may repeat the chosen page id: one of them is the response
    twin = F.row_number().over(Window.partitionBy("page_id", *key).orderBy("url"))
    marked = marked.withColumn("kind", F.when(
        (F.col("length") < least) | (is_chosen & (twin == 1)), "response").otherwise("revisit"))
    odd = F.when(F.col("url").rlike(r"\p{Cntrl}"), F.col("url")).alias("odd_url")
    headers(marked).select("page_id", *key, "kind", "header", odd).write.parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with its header, full payload, exact record bytes and exact url."""
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads")
    body = records.join(payloads, ["digest", "sha256", "length"])
    ends = F.lit("\r\n\r\n").cast("binary")
    target = r"\r\nWARC-Target-URI: ([^\r\n]*)"
    url = F.coalesce("odd_url", F.when(F.col("header").rlike(target), F.regexp_extract("header", target, 1))).alias("url")
    return body.select("page_id", url, "header", "payload", F.concat(
        F.col("header").cast("binary"),
        F.when(F.col("kind") == "response", F.col("payload")).otherwise(F.lit("").cast("binary")), ends).alias("record"))


def parsed(records: DataFrame) -> DataFrame:
    """What the rebuilt records say, by their own headers and payloads."""
    field = lambda name: F.regexp_extract("header", rf"(?m)^{name}: ([^\r\n]*)", 1)
    page = lambda name: F.nullif(F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")
    said = F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")
    found = base32_of_sha1(F.sha1("payload"))
    return records.select(
        page("WARC-Record-ID").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.when(said == found, said).otherwise(
            F.raise_error(F.concat(F.lit("payload differs from its digest: "), said))).alias("payload_digest"),
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    from .common import table

    folder = f"{shared_dir(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), folder)
    return parsed(read_archive(spark, folder))


OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY html) AS last
  FROM (SELECT page_id, coalesce(html, '') AS html FROM pages)
), bits AS (
  SELECT *, [('0x' || substr(h, 5 * g + 1, 5))::BIGINT FOR g IN range(8)] AS v FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((v[(i // 4) + 1] >> (5 * (3 - i % 4))) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM bits
"""
