"""Terms the lexicon does not know."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import gaps
from .. import corpus
from ..corpus import GAPS, LEXICON
from . import sql

_IN = lambda words: "(" + ", ".join(map(sql.literal, words)) + ")"
_STAGES = "|".join(GAPS.stages)
_LETTERS = r"[\x{00AA}\x{00B5}\x{00BA}\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{024F}]"

LINES = rf"""ln as (select document, page, unnest(string_split(text, chr(10))) as line,
  unnest(range(len(string_split(text, chr(10))))) as no from pages_),
lm as (select document, page, no, {sql.strip('line')} as stripped, regexp_replace(line, '{_LETTERS}', '0', 'g') as line from ln),
lk as (select *, regexp_replace(stripped, '{_LETTERS}', '0', 'g') as st, regexp_matches(line, '(?i)\b(spray|anthe|apply|onou\w+|mit|que)\b') as advisory
  from lm where stripped <> ''),
known as (select distinct document, page, no from lk join lex on advisory and dimension = 'subject' and {sql.mentions('lk.stripped', 'lex.alias')}),
fl as (select lk.*, advisory and known.no is null as unresolved from lk left join known using (document, page, no))"""

TERMS = rf"""raw as (
  select document, page, no, 'stage-column' as signal, unnest(regexp_extract_all(line,
    '(?i)((?:[A-Z][a-z]+[ /-]{{0,2}}){{1,3}})\s*[\(\-–—:]?\s*(?:{_STAGES})\b', 1)) as t from fl
  union all select document, page, no, 'table-cell', st from fl where length(st) between 4 and 30
    and regexp_matches(st, '^(?:[A-Z][a-z]+|[a-z]{{4,}})(?:[ /-][A-Za-z]+){{0,2}}$')
  union all select document, page, no, 'advisory-object', unnest(regexp_extract_all(line,
    '\b(?:in|of|on|for)\s+([A-Za-z]{{4,}}(?:[ -][a-z]{{3,}})?)\b', 1)) from fl where advisory
  union all select document, page, no, 'advisory-no-subject', regexp_extract(st, '^([A-Z][a-z]+(?:[ /-][A-Za-z]+){{0,2}})', 1) from fl
    where unresolved and regexp_matches(st, '^[A-Z][a-z]+')),
cl as (select * exclude (t), {sql.strip(r"trim(regexp_replace(t, '\s+', ' ', 'g'), ' -/:()')")} as t from raw),
tm as (select * exclude (t), upper(substr(t, 1, 1)) || lower(substr(t, 2)) as term from cl),
tk as (select *, lower(term) as low, string_split(lower(term), ' ') as w from (select distinct term from tm)),
ok1 as (select term, low from tk where length(term) between 4 and 32 and low not in {_IN(GAPS.stop)}
  and w[1] not in {_IN(GAPS.leading_verbs)} and w[1] not in {_IN(GAPS.stop)}
  and not (len(w) > 1 and w[-1] in {_IN(GAPS.stop)})
  and not list_has_any(w, {list(GAPS.function_words)}) and not list_has_any(w, {list(GAPS.stage_words)})
  and low not in {_IN(GAPS.not_a_subject)} and not regexp_matches(term, '{GAPS.chemical}')
  and low not in ('xavia', 'xebra', 'xocal') and regexp_matches(term, '{GAPS.title}')),
ok as (select term from ok1 where not exists (select 1 from lex where dimension in ('subject', 'district') and {sql.mentions('ok1.term', 'lex.alias')})),
found as (select tm.* from tm join ok using (term)),
cand as (select document, term, count(*) as hits, count(distinct page) as pages, string_agg(distinct signal, '+' order by signal) as signals,
  count(*) * (case when count(distinct signal) > 1 then 2 else 1 end) as score from found group by 1, 2)"""

BASE = f"with {sql.lexicon()}, {sql.PAGES}, {LINES}, {TERMS}"


def found(spark, sf):
    return gaps.occurrences(corpus.pages(spark, sf), LEXICON, GAPS)


def candidates(spark, sf):
    return gaps.candidates(found(spark, sf), GAPS).withColumn("signals", F.array_join("signals", "+"))


CANDIDATE_SQL = f"{BASE} select * from cand"


def ranked(spark, sf):
    return gaps.ranked(gaps.candidates(found(spark, sf), GAPS), 30).select("document", "term", "score", F.col("rank").cast("long").alias("rank"))


RANKED_SQL = f"""{BASE} select document, term, score, row_number() over (partition by document order by score desc, term) as rank
from cand qualify rank <= 30"""


def evidence(spark, sf):
    return gaps.evidence(found(spark, sf), GAPS).withColumn("evidence", F.array_join("evidence", " / "))


EVIDENCE_SQL = f"""{BASE},
e as (select f.document, f.term, f.page, f.no, 'p.' || f.page || '  ' || substr(l.stripped, 1, 110) as line,
  row_number() over (partition by f.document, f.term order by f.page, f.no) as rn from found f join lk l using (document, page, no))
select document, term, string_agg(line, ' / ' order by rn) as evidence from e where rn <= 2 group by 1, 2"""


def across(spark, sf):
    return gaps.across_documents(gaps.candidates(found(spark, sf), GAPS))


ACROSS_SQL = f"{BASE} select term, cast(sum(hits) as bigint) as hits, count(*) as documents from cand group by 1 order by hits desc, term limit 15"


def advisory_lines(spark, sf):
    return gaps.advisory_counts(corpus.pages(spark, sf), LEXICON, GAPS)


ADVISORY_SQL = f"""with {sql.lexicon()}, {sql.PAGES}, {LINES} select document, count(*) filter (advisory) as advisory_lines,
 count(*) filter (unresolved) as unresolved_lines from fl group by 1"""

QUERIES = {
    "gap_candidates": (candidates, CANDIDATE_SQL),
    "gap_ranking": (ranked, RANKED_SQL),
    "gap_evidence": (evidence, EVIDENCE_SQL),
    "gap_across_documents": (across, ACROSS_SQL),
    "gap_advisory_lines": (advisory_lines, ADVISORY_SQL),
}
