"""Functions of one text: normalising, matching, scripts, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import prose, script, text as tx, vectors
from ...operators import automaton, lexicon as lx, pages as pg, report
from ...operators.facets import category_of
from ...session import settle
from .. import corpus
from ..corpus import LEXICON, SETTINGS, table
from . import sql

CONSONANTS = "a-z"
ACCENTS = (
    ("fr", "Graves", 0x00E0, 0x00EA, ("fr", "it")),
    ("de", "Umlauts", 0x00F0, 0x00FF, ("de",)),
    ("es", "Middle", 0x00EB, 0x00EF, ()),
)
MARKERS = ("the", "que", "und", "de", "of")


def tidy_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.tidy("text").alias("t")).select(
        "doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


TIDY_SQL = f"""with t as (select doc_id, {sql.tidy('text')} as t from documents)
select doc_id, cast(length(t) as integer) as n_chars, md5(t) as digest from t"""


def _hits(spark, sf):
    return table(spark, sf, "documents").withColumn("hits", lx.Matcher(LEXICON.aliases()).mentions("text"))


def topic_counts(spark, sf):
    topics = lx.to_canonical(F.col("hits"), LEXICON.rows("topic"))
    return _hits(spark, sf).select(F.explode(topics).alias("topic")).groupBy("topic").agg(
        F.count("*").alias("documents"))


TOPIC_SQL = f"""with {sql.lexicon()}
select canonical as topic, count(distinct doc_id) as documents from documents join lex
on dimension = 'topic' and {sql.mentions('text')} group by 1"""


def match_pairs(spark, sf):
    df = _hits(spark, sf)

    def tagged(d):
        return F.transform(lx.to_canonical(F.col("hits"), LEXICON.rows(d)),
                           lambda c: F.struct(F.lit(d).alias("dimension"), c.alias("canonical")))

    tags = [tagged(d) for d in ("subject", "topic", "weather")]
    return df.select("doc_id", F.explode(F.concat(*tags)).alias("m")).select("doc_id", "m.dimension", "m.canonical")


PAIRS_SQL = f"""with {sql.lexicon()}
select distinct doc_id, dimension, canonical from documents join lex on dimension <> 'district' and {sql.mentions('text')}"""


def match_pairs_joined(spark, sf):
    """The route for lexicons too large to inline, on the same lexicon."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    frame = settle(LEXICON.frame(spark).where("dimension <> 'district'").drop("is_latin"), "lexicon")
    return lx.match_by_join(docs, frame, "doc_id").select("doc_id", "dimension", "canonical").distinct()


def match_pairs_by_machine(spark, sf):
    """The route for lexicons between the two, on the same lexicon."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    frame = LEXICON.frame(spark).where("dimension <> 'district'")
    return automaton.match(docs, frame, "doc_id").select("doc_id", "dimension", "canonical").distinct()


def benchmark_words(spark, sf):
    """A lexicon as large as a table makes it: every word of the benchmark, and how many of them each document mentions."""
    words = table(spark, sf, "benchmark").select(F.explode(lx.letter_runs("text")).alias("word")).where("word <> ''").distinct()
    return automaton.known_words(table(spark, sf, "documents"), settle(words, "vocabulary"), "doc_id", "word")


BENCHMARK_SQL = """with w as (select distinct unnest(regexp_split_to_array(lower(text), '[^a-z]+')) as word from benchmark),
d as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) as word from documents)
select doc_id, count(*) as words from d join w using (word) where word <> '' group by 1"""


def scoped_matches(spark, sf):
    state = F.when(F.col("lang") == "fr", "XA").when(F.col("lang") == "de", "XB").otherwise("XC")
    hits = _hits(spark, sf).withColumn("state", state)
    return hits.select("doc_id", "state", F.explode(
        lx.districts_of(F.col("hits"), F.col("state"), LEXICON)).alias("area_code"))


SCOPED_SQL = f"""with {sql.lexicon()}
select distinct doc_id, scope as state, canonical as area_code from documents join lex on dimension = 'district'
and scope = case lang when 'fr' then 'XA' when 'de' then 'XB' else 'XC' end and {sql.mentions('text')}"""


def _part_lexicon(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_type").alias("dimension"), F.lit("").alias("scope"), F.lower("p_name").alias("alias"),
        F.col("p_brand").alias("canonical"), F.col("p_name").alias("name")).distinct()


def alias_collision(spark, sf):
    return lx.alias_collisions(_part_lexicon(spark, sf))


COLLISION_SQL = f"""with l as (select distinct p_type as dimension, '' as scope, lower(p_name) as alias, p_brand as canonical,
 p_name as name from part),
n as (select dimension, scope, canonical, min(name) as name from l group by all)
select distinct l.dimension, l.scope, n.canonical as named, l.alias, l.canonical from n join l
on n.dimension = l.dimension and n.scope = l.scope and n.canonical <> l.canonical and {sql.mentions('lower(n.name)', 'l.alias')}"""


def shared_alias(spark, sf):
    return lx.shared_aliases(_part_lexicon(spark, sf).select("dimension", "alias")).select(
        "alias", F.array_join("dimensions", ",").alias("dimensions"))


SHARED_SQL = """select lower(p_name) as alias, string_agg(distinct p_type, ',' order by p_type) as dimensions
from part group by 1 having count(distinct p_type) > 1"""


def unresolved(spark, sf):
    none = F.size(lx.to_canonical(F.col("hits"), LEXICON.rows("subject"))) == 0
    return _hits(spark, sf).where(none).select("doc_id", "source")


UNRESOLVED_SQL = f"""with {sql.lexicon()}
select doc_id, source from documents d where not exists (select 1 from lex where dimension = 'subject' and {sql.mentions('d.text')})"""


def script_profile(spark, sf):
    counts = {f"n_{s.lower()}": script.chars_in("text", script._span(lo, hi)) for _, s, lo, hi, _ in ACCENTS}
    return table(spark, sf, "documents").select(
        "doc_id", script.letters("text").alias("letters"), *[c.alias(n) for n, c in counts.items()])


def _count_sql(lo, hi):
    return f"cast(length(regexp_replace(text, '[^\\x{{{lo:04X}}}-\\x{{{hi:04X}}}]+', '', 'g')) as integer)"


PROFILE_SQL = ("select doc_id, cast(length(regexp_replace(text, '\\P{L}+', '', 'g')) as integer) as letters, "
               + ", ".join(f"{_count_sql(lo, hi)} as n_{s.lower()}" for _, s, lo, hi, _ in ACCENTS) + " from documents")


def language_reading(spark, sf):
    r = script.detect("text", SETTINGS, ACCENTS)
    return table(spark, sf, "documents").select("doc_id", r.alias("r")).select(
        "doc_id", "r.language", "r.script", "r.script_chars", "r.letter_chars",
        F.round("r.ratio", 6).alias("ratio"), "r.ambiguous", F.array_join("r.siblings", ",").alias("siblings"))


READING_SQL = f"""with c as (select doc_id, cast(length(regexp_replace(text, '\\P{{L}}+', '', 'g')) as integer) as letters,
  {', '.join(f"{_count_sql(lo, hi)} as c{i}" for i, (_, _, lo, hi, _) in enumerate(ACCENTS))} from documents),
m as (select *, case when letters = 0 then 0 else greatest(c0, c1, c2) end as n from c),
r as (select *, case when letters = 0 then 0.0 else n / letters end as q from m),
k as (select *, letters > 0 and n >= 15 and q >= 0.05 as ok, case when c0 = n then 0 when c1 = n then 1 else 2 end as w from r)
select doc_id, case when not ok then 'en' else ['fr', 'de', 'es'][w + 1] end as language,
 case when not ok then 'Latin' else ['Graves', 'Umlauts', 'Middle'][w + 1] end as script,
 n as script_chars, letters as letter_chars, round(q, 6) as ratio, ok and w < 2 as ambiguous,
 case when not ok then '' else ['fr,it', 'de', ''][w + 1] end as siblings from k"""


def marker_density(spark, sf):
    reading = script.encoding(script.chars_in("text", "a-z"), script.marker_hits("text", MARKERS), 12.0)
    return table(spark, sf, "documents").select("doc_id", reading.alias("r")).select(
        "doc_id", "r.script_chars", "r.marker_hits", F.round("r.markers_per_1k", 6).alias("per_1k"), "r.healthy")


_MARK = " + ".join(f"(length(text) - length(replace(text, '{m}', ''))) // {len(m)}" for m in MARKERS)
DENSITY_SQL = f"""with c as (select doc_id, cast(length(regexp_replace(text, '[^a-z]+', '', 'g')) as integer) as n,
 cast({_MARK} as integer) as hits from documents),
d as (select *, case when n > 0 then 1000.0 * hits / n else 0.0 end as per from c)
select doc_id, n as script_chars, hits as marker_hits, round(per, 6) as per_1k, n = 0 or per >= 12.0 as healthy from d"""


def repair_scores(spark, sf):
    fix = lambda c: script.repair_glyphs(c, ("ti", "it"), "h", CONSONANTS, (("ou", "u"), ("nn", "n")))
    docs = table(spark, sf, "documents").select(F.col("source").alias("document"), "text")
    return pg.repair_scores(docs, list(corpus.REPAIR_TERMS), fix)


_TERMS = ", ".join(map(sql.literal, corpus.REPAIR_TERMS))
REPAIR_SQL = f"""with t as (select unnest([{_TERMS}]) as t),
d as (select source as document, text, replace(replace(regexp_replace(translate(text, 'ti', 'it'), 'h([a-z])', '\\1h', 'g'),
  'ou', 'u'), 'nn', 'n') as fixed from documents),
s as (select document, count(distinct t) filter (contains(text, t)) as terms_before,
  count(distinct t) filter (contains(fixed, t)) as terms_after from d cross join t group by 1)
select *, terms_after > terms_before as repair_applied from s"""


def slug_ids(spark, sf):
    code = tx.district_code(F.col("p_brand"), F.col("p_name"))
    return table(spark, sf, "part").select(
        "p_partkey", tx.slugify("p_brand").alias("slug"), code.alias("district_code"),
        tx.subject_code(tx.slugify("p_name")).alias("subject_code"),
        tx.resource_id(F.lit("prov-parts"), F.col("p_type"), F.col("p_name"), code).alias("resource_id"),
        tx.catalog_id(F.col("p_type"), F.col("p_name"), F.col("p_brand")).alias("catalog_id"))


_CODE = "p_brand || '-' || upper(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g'), '-'))"
SLUG_SQL = f"""select p_partkey, {sql.slug('p_brand')} as slug, {_CODE} as district_code,
replace(upper({sql.slug('p_name')}), '-', '_') as subject_code,
'res-parts-' || {sql.slug('p_type')} || '-' || {sql.slug('p_name')} || '-' || {sql.slug(_CODE)} as resource_id,
'cat-' || {sql.slug('p_type')} || '-' || {sql.slug('p_name')} || '-' || {sql.slug('p_brand')} as catalog_id from part"""


def point_ids(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.point_id(
        F.lit("prov-corpus"), F.col("source"), F.col("doc_id"), F.col("n_chars")).alias("point_id"),
        tx.citation("source", "doc_id").alias("citation"))


POINT_SQL = f"""select doc_id, {sql.uuid5("'prov-corpus:' || source || ':' || doc_id || ':' || n_chars")} as point_id,
source || ' p.' || doc_id as citation from documents"""


def category_case(spark, sf):
    df = lx.with_mentions(table(spark, sf, "documents"), LEXICON)
    category = category_of(F.col("subject_slugs"), F.col("topics"), LEXICON)
    none = F.array().cast("array<string>")
    weather = F.col("category") == "Weather"
    return df.withColumn("category", category).select(
        "doc_id", "category",
        F.array_join(F.when(weather, none).otherwise(F.col("subject_slugs")), ",").alias("subjects"),
        F.array_join(F.when(weather, F.col("weather_parameters")).otherwise(none), ",").alias("weather"))


CATEGORY_SQL = f"""with {sql.lexicon()},
rows_ as (select source as document, doc_id as page, doc_id as ordinal, text, '' as state_code, cast([] as varchar[]) as section from documents),
{sql.facets()}
select page as doc_id, category, {sql.joined('subjects')} as subjects, {sql.joined('weather')} as weather from facets_"""


def prose_texts(spark, sf):
    lines = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.posexplode(tx.lines_of("text")).alias("line_no", "line"))
    return lines.select("conv_id", "turn", "line_no",
                        prose.is_prose("line", r"(?i)\b(from|per\s+the|ther\w+)").alias("prose"))


PROSE_SQL = r"""with l as (select conv_id, turn, unnest(string_split(text, chr(10))) as line,
  cast(unnest(range(len(string_split(text, chr(10))))) as integer) as line_no from conversations)
select conv_id, turn, line_no, regexp_matches(line, '(?i)(^|[^\w\x{0080}-\x{024F}])(from|per\s+the|ther\w+)')
  or regexp_matches(line, '(?:\S+\s+){14}\S') as prose from l"""


def durations(spark, sf):
    """Durations and language codes, as order rows spell them."""
    d = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1), F.substring("o_orderstatus", 1, 1))
    t = F.when(F.col("o_orderkey") % 3 == 0, F.lit("PT5H")).when(F.col("o_orderkey") % 3 == 1, F.lit("P")).otherwise(
        F.concat(F.lit("P"), (F.col("o_custkey") % 9).cast("string"), F.lit("D")))
    code = F.lower(F.substring("o_orderpriority", 3, 2))
    return table(spark, sf, "orders").select(
        "o_orderkey", prose.is_duration(d).alias("status_duration"), prose.is_duration(t).alias("duration"),
        prose.is_language_code(code).alias("language_code"))


DURATION_SQL = r"""with o as (select o_orderkey, 'P' || substr(o_orderpriority, 1, 1) || substr(o_orderstatus, 1, 1) as d,
 case o_orderkey % 3 when 0 then 'PT5H' when 1 then 'P' else 'P' || (o_custkey % 9) || 'D' end as t,
 lower(substr(o_orderpriority, 3, 2)) as c from orders)
select o_orderkey, d <> 'P' and regexp_matches(d, '^P(\d+[YMWD])*(T(\d+[HMS])+)?$') as status_duration,
 t <> 'P' and regexp_matches(t, '^P(\d+[YMWD])*(T(\d+[HMS])+)?$') as duration,
 regexp_matches(c, '^[a-z]{2}$') as language_code from o"""


def token_stats(spark, sf):
    return report.token_report(table(spark, sf, "documents"), SETTINGS).withColumn(
        "mean_tokens", F.round("mean_tokens", 6))


TOKEN_SQL = r"""with t as (select len(regexp_extract_all(text, '\S+')) as n from documents)
select count(*) as passages, cast(max(n) as bigint) as max_tokens, round(avg(n), 6) as mean_tokens,
 count(*) filter (n > 512) as over_limit from t"""


def hashed_grams(spark, sf):
    """Cell counts of the lexical embedding, hashed with a digest both engines have."""
    return vectors.gram_cells(table(spark, sf, "documents"), "doc_id")


GRAM_SQL = r"""with t as (select doc_id, trim(regexp_replace(lower(text), '[\s\x{00A0}]+', ' ', 'g')) as t from documents),
g as (select doc_id, substr(t, cast(i as bigint), 3) as g from (select doc_id, t, unnest(range(1, length(t) - 1)) as i from t)),
c as (select doc_id, g, count(*) as n from g group by 1, 2)
select doc_id, cast(cast('0x' || substr(md5(g), 1, 8) as bigint) % 64 as integer) as cell, cast(sum(n) as bigint) as n
from c group by 1, 2"""

QUERIES = {
    "tidy_text": (tidy_text, TIDY_SQL),
    "lexicon_topic_counts": (topic_counts, TOPIC_SQL),
    "lexicon_match_pairs": (match_pairs, PAIRS_SQL),
    "lexicon_match_by_join": (match_pairs_joined, PAIRS_SQL),
    "lexicon_match_by_machine": (match_pairs_by_machine, PAIRS_SQL),
    "benchmark_words": (benchmark_words, BENCHMARK_SQL),
    "scoped_lexicon_match": (scoped_matches, SCOPED_SQL),
    "alias_collisions": (alias_collision, COLLISION_SQL),
    "shared_aliases": (shared_alias, SHARED_SQL),
    "unresolved_documents": (unresolved, UNRESOLVED_SQL),
    "letter_and_script_profile": (script_profile, PROFILE_SQL),
    "dominant_script": (language_reading, READING_SQL),
    "marker_density": (marker_density, DENSITY_SQL),
    "repair_gate_scores": (repair_scores, REPAIR_SQL),
    "slug_ids": (slug_ids, SLUG_SQL),
    "uuid5_point_ids": (point_ids, POINT_SQL),
    "category_case": (category_case, CATEGORY_SQL),
    "prose_detector": (prose_texts, PROSE_SQL),
    "durations_and_codes": (durations, DURATION_SQL),
    "token_stats": (token_stats, TOKEN_SQL),
    "lexical_embedding_cells": (hashed_grams, GRAM_SQL),
}
