"""Pages to passages: segmentation, sections, facets and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import facets, pages as pg, report as rp
from ...operators.segment import with_blocks
from ...session import settle
from .. import corpus, onboard
from ..corpus import HEADING, LEXICON, SETTINGS
from . import sql


def extraction(spark, sf):
    return onboard.extract(corpus.pages(spark, sf), LEXICON, SETTINGS, rule=HEADING)


def line_passages(spark, sf):
    """Every line as a passage; nothing is merged or carried."""
    pages = corpus.pages(spark, sf)
    decisions = pg.document_decisions(pages, LEXICON, SETTINGS, settle)
    rows = pg.apply_decisions(pages, decisions, SETTINGS).select(
        "document", "page", "state_code", F.col("ocr").alias("from_ocr"),
        F.posexplode(F.split("text", "\n")).alias("i", "text"),
    ).select(
        "document", "page", (F.col("page") * 100000 + F.col("i")).alias("ordinal"), "text", "state_code",
        F.lit(None).cast("array<string>").alias("section"), "from_ocr")
    return facets.resolve(rows, LEXICON, SETTINGS)


def flat(passages):
    """Nested facets as comma-joined strings, for comparison."""
    return passages.select(
        "document", "page", "ordinal", F.md5("text").alias("text"), "language", "category",
        F.array_join("subjects.slug", ",").alias("subjects"), F.col("area.code").alias("area_code"),
        F.array_join("also_covers.code", ",").alias("also"), F.array_join("topics", ",").alias("topics"),
        F.array_join("weather_parameters", ",").alias("weather"), "resource_id", "point_id")


FLAT_SQL = f"""select document, page, ordinal, md5(text) as text, language, category, {sql.joined('subjects')} as subjects,
 area_code, {sql.joined('also')} as also, {sql.joined('topics')} as topics, {sql.joined('weather')} as weather, resource_id,
 {sql.uuid5("'prov-corpus:' || document || ':' || page || ':' || ordinal")} as point_id from facets_"""


def line_facets(spark, sf):
    return flat(line_passages(spark, sf))


LINE_SQL = f"with {sql.LINE_FACETS} {FLAT_SQL}"

# Segmentation as recursion: lines to runs, runs to pieces, pieces to passages.
SEGMENTS = f"""
ln as (select document, page, state_code, unnest(string_split(text, chr(10))) as line,
  unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from accepted_),
lc0 as (select ln.document, ln.page, ln.i, list(distinct canonical order by canonical) as crops
  from ln join lex on dimension = 'subject' and {sql.mentions('ln.line', 'lex.alias')} group by 1, 2, 3),
lc as (select ln.document, ln.page, ln.i, ln.line, coalesce(crops, []) as crops from ln left join lc0 using (document, page, i)),
run as (select document, page, i, line as buf, crops, false as brk from lc where i = 1
  union all
  select l.document, l.page, l.i, case when x.brk then l.line else r.buf || chr(10) || l.line end,
    case when x.brk then l.crops else list_distinct(list_concat(r.crops, l.crops)) end, x.brk
  from run r join lc l on l.document = r.document and l.page = r.page and l.i = r.i + 1,
    lateral (select len(r.crops) > 0 and len(l.crops) > 0 and not list_has_any(r.crops, l.crops) and length(r.buf) >= 80 as brk) x),
runs as (select document, page, buf, crops, row_number() over (partition by document, page order by i) as k from
  (select *, lead(brk) over (partition by document, page order by i) as closing from run) where closing is null or closing),
fold as (select document, page, k, buf, crops, false as fresh from runs where k = 1
  union all
  select r.document, r.page, r.k, case when x.fresh then r.buf else f.buf || chr(10) || r.buf end,
    case when x.fresh then r.crops else list_distinct(list_concat(f.crops, r.crops)) end, x.fresh
  from fold f join runs r on r.document = f.document and r.page = f.page and r.k = f.k + 1,
    lateral (select length(r.buf) >= 80 and length(f.buf) >= 80 as fresh) x),
pieces as (select document, page, buf, crops, row_number() over (partition by document, page order by k) as m from
  (select *, lead(fresh) over (partition by document, page order by k) as closing from fold) where closing is null or closing),
step as (select document, page, 1 as s, 1 as m, buf, crops, cast(null as varchar) as out, false as done from pieces where m = 1
  union all
  select document, page, s + 1, case when act in ('fill', 'emit', 'join') then m + 1 else m end,
    case act when 'cut' then {sql.strip('substr(buf, cutat + 1)')} when 'fill' then p when 'emit' then p
      when 'join' then buf || chr(10) || chr(10) || p else '' end,
    case act when 'fill' then pc when 'emit' then pc when 'join' then list_distinct(list_concat(crops, pc)) else crops end,
    case act when 'cut' then {sql.strip('substr(buf, 1, cutat)')} when 'emit' then buf when 'last' then buf end,
    act = 'last'
  from (select w.*, n.buf as p, n.crops as pc,
      case when length(w.buf) > 700 then 'cut'
           when n.buf is null then 'last'
           when w.buf = '' then 'fill'
           when len(w.crops) > 0 and len(n.crops) > 0 and not list_has_any(w.crops, n.crops) and length(w.buf) >= 80 then 'emit'
           when length(w.buf) + length(n.buf) + 2 <= 700 then 'join' else 'emit' end as act,
      case when length(regexp_extract(substr(w.buf, 1, 700), '(?s)^(.*)\\n', 1)) > 0
           then length(regexp_extract(substr(w.buf, 1, 700), '(?s)^(.*)\\n', 1)) else 700 end as cutat
    from step w left join pieces n on n.document = w.document and n.page = w.page and n.m = w.m + 1 where not w.done)),
blocks as (select document, page, out as text, row_number() over (partition by document, page order by s) as b
  from step where length(out) >= 80)"""


def page_blocks(spark, sf):
    pages = corpus.pages(spark, sf)
    accepted = pg.apply_decisions(pages, pg.document_decisions(pages, LEXICON, SETTINGS, settle), SETTINGS)
    return with_blocks(accepted, LEXICON, SETTINGS).select(
        "document", "page", F.posexplode("blocks").alias("i", "text")).select(
        "document", "page", (F.col("i") + 1).cast("long").alias("block"), F.length("text").alias("chars"),
        F.md5("text").alias("digest"))


SEGMENT_SQL = f"""with recursive {sql.lexicon()}, {sql.PAGES}, {sql.STATE}, {sql.GATE}, {SEGMENTS}
select document, page, b as block, cast(length(text) as integer) as chars, md5(text) as digest from blocks"""

_HEAD = HEADING.pattern.replace("'", "''")


def _named(text):
    return f"regexp_extract({text}, '{_HEAD}', 1)"


SECTIONS = f"""
ev as (select document, page, state_code, 0 as kind, i as pos, line as text from ln
  union all select b.document, b.page, a.state_code, 1, b.b, b.text from blocks b join accepted_ a using (document, page)),
hd as (select *, {sql.strip(_named('text'))} as nm from ev),
part as (select document, page, state_code, kind, pos, {sql.strip("unnest(regexp_split_to_array(nm, '[/,&]| and '))")} as part,
  unnest(range(len(regexp_split_to_array(nm, '[/,&]| and ')))) as j from hd where nm <> ''),
area as (select distinct document, page, part.kind, pos, j, canonical from part join lex on dimension = 'district' and scope = state_code
  and {sql.mentions('part.part', 'lex.alias')}),
arear as (select document, page, kind, pos, canonical, min((j, canonical)) as pl from area group by all),
head as (select document, page, kind, pos, list(canonical order by pl) as sec from arear group by 1, 2, 3, 4),
filled as (select e.*, last_value(h.sec ignore nulls) over (partition by document order by page, kind, pos
  rows between unbounded preceding and current row) as sec from ev e left join head h using (document, page, kind, pos)),
rows_ as (select document, page, row_number() over (partition by document order by page, pos) - 1 as ordinal, text, state_code,
  coalesce(sec, []) as section from filled where kind = 1)"""

FULL = f"""with recursive {sql.lexicon()}, {sql.PAGES}, {sql.STATE}, {sql.GATE}, {SEGMENTS}, {SECTIONS}, {sql.facets()}, {sql.NAMES}"""


def passages(spark, sf):
    return flat(extraction(spark, sf).passages)


PASSAGES_SQL = f"{FULL} {FLAT_SQL}"


def extraction_report(spark, sf):
    hist = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return extraction(spark, sf).report.select(
        "document", "pages", "passages", "with_subject", "with_district", "districts",
        hist("languages").alias("languages"), hist("categories").alias("categories"),
        F.round("subject_resolution", 6).alias("subject_resolution"),
        F.round("district_resolution", 6).alias("district_resolution"), F.array_join("warnings", "; ").alias("warnings"),
        "char_count", "ocr_pages", "thin_pages", "empty_pages", "unread_pages", "thin_warning",
        F.col("encoding.healthy").alias("healthy"))


REPORT_SQL = f"""{FULL},
v as (select f.*, a.level = 'District' as d, list_filter(list_concat([f.area_code], also), lambda c: c like '%-%') as codes
  from facets_ f join areas_ a on a.code = area_code),
r as (select document, count(*) as passages, count(*) filter (len(subjects) > 0) as with_subject,
  count(*) filter (len(codes) > 0) as with_district from v group by 1),
k as (select document, count(distinct c) as districts from (select document, unnest(codes) as c from v) group by 1),
c as (select document, string_agg(category || '=' || n, ',' order by category) as categories from
  (select document, category, count(*) as n from v group by 1, 2) group by 1),
p as (select document, count(*) as pages, cast(sum(length(text)) as bigint) as char_count,
  count(*) filter (length(text) >= 40 and length(text) < 150) as thin_pages, count(*) filter (length(text) < 40) as empty_pages
  from accepted_ group by 1)
select document, pages, passages, with_subject, with_district, coalesce(districts, 0) as districts, 'en=' || passages as languages, categories,
 round(with_subject / passages, 6) as subject_resolution, round(with_district / passages, 6) as district_resolution,
 array_to_string(list_filter([case when coalesce(districts, 0) = 0 then 'no district resolved: everything publishes at state level' end,
   case when with_subject / passages < 0.4 then 'only ' || with_subject || ' of ' || passages || ' passages resolved to a subject' end],
   lambda w: w is not null), '; ') as warnings,
 char_count, cast(0 as bigint) as ocr_pages, thin_pages, empty_pages, thin_pages + empty_pages as unread_pages,
 thin_pages + empty_pages > 0 and (thin_pages + empty_pages) / pages >= 0.4 as thin_warning, true as healthy
from r join c using (document) join p using (document) left join k using (document)"""


def run_outcomes(spark, sf):
    """Every document with its outcome: onboarded, refused or failed."""
    return extraction(spark, sf).decisions.select("document", "pages", "status", "state_code", "repair_applied")


OUTCOME_SQL = f"""with {sql.PAGES}, {sql.STATE}, {sql.GATE}
select document, pages, case when state_code is not null and usable > 0 and usable / pages >= 0.5 then 'ok' else 'refused' end as status,
 state_code, false as repair_applied from gate_ join states_ using (document)"""

def _recovered(spark, sf):
    """Pages cut short, with what a stand-in engine reads from their pictures: for a third of them the whole page, for a
    third its end, for some nothing but an error."""
    n = F.col("page")
    full = corpus.pages(spark, sf)
    failed = n % 7 == 0
    return full.select(
        "document", "page", F.substring("text", 1, 100).alias("text"), "ocr", "has_image",
        F.when(failed, None).when(n % 3 == 0, F.col("text")).when(n % 3 == 1, F.substring("text", -60, 60)).alias("recovered"),
        F.when(failed, F.lit("no answer from the engine")).alias("error"))


def recovery_gate(spark, sf):
    """Which recovered texts are taken: more known terms, long enough, two topics."""
    scored = pg.accept_recovered(_recovered(spark, sf), LEXICON, SETTINGS)
    return scored.select("document", "page", "ocr_attempted", "ocr_accepted", "ocr", "terms_before", "terms_after",
                         "chars_before", "chars_after", F.md5("text").alias("text"))


def recovery_counts(spark, sf):
    """Attempted, accepted and failed pages of each document, and what was gained."""
    return pg.recovery_report(pg.accept_recovered(_recovered(spark, sf), LEXICON, SETTINGS))


def _terms(of: str) -> str:
    return f"""(select count(distinct case dimension when 'subject' then canonical end) + count(distinct case dimension when 'district'
 then scope || ' ' || canonical end) from lex where dimension in ('subject', 'district') and {sql.mentions(of, 'lex.alias')})"""


RECOVERED = f"""with {sql.lexicon()}, {sql.PAGES},
s_ as (select document, page, substr(text, 1, 100) as own, text as whole from pages_),
t_ as (select document, page, own, case when page % 7 = 0 then null when page % 3 = 0 then whole when page % 3 = 1 then whole[-60:] end as rec,
  case when page % 7 = 0 then 'no answer from the engine' end as error from s_),
m_ as (select *, {sql.strip('own || chr(10) || rec')} as merged from t_),
k_ as (select *, cast({_terms('own')} as integer) as before, cast({_terms("coalesce(merged, '')")} as integer) as after,
  (select count(distinct canonical) from lex where dimension = 'topic' and {sql.mentions("coalesce(rec, '')", 'lex.alias')}) as topics from m_),
g_ as (select *, coalesce(merged is not null and after > before and length({sql.strip('rec')}) >= 120 and topics >= 2, false) as ok from k_),
gate_ as (select document, page, rec is not null or error is not null as ocr_attempted, ok as ocr_accepted, ok as ocr, before as terms_before,
  case when ok then after else before end as terms_after, cast(length({sql.strip('own')}) as integer) as chars_before,
  cast(case when ok then length(merged) else length({sql.strip('own')}) end as integer) as chars_after,
  md5(case when ok then merged else own end) as text, error from g_)"""
RECOVERY_SQL = f"{RECOVERED} select * exclude (error) from gate_"
RECOVERY_COUNTS_SQL = f"""{RECOVERED} select document, count(*) filter (ocr_attempted) as pages_attempted, count(*) filter (ocr_accepted) as pages_accepted,
 count(error) as pages_errored, any_value(error) as first_error, cast(sum(chars_before) as bigint) as chars_before,
 cast(sum(chars_after) as bigint) as chars_after, cast(sum(terms_before) as bigint) as terms_before,
 cast(sum(terms_after) as bigint) as terms_after from gate_ group by 1"""

QUERIES = {
    "recovery_gate": (recovery_gate, RECOVERY_SQL),
    "recovery_counts": (recovery_counts, RECOVERY_COUNTS_SQL),
    "segment_passages": (page_blocks, SEGMENT_SQL),
    "passages": (passages, PASSAGES_SQL),
    "line_facets": (line_facets, LINE_SQL),
    "extraction_report": (extraction_report, REPORT_SQL),
    "run_outcomes": (run_outcomes, OUTCOME_SQL),
}
