"""Resources, catalogues, validation, publishing and the ledger."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ...functions.text import capability_of
from ...operators import discover as dc, facets, publishing as pb, resources as res, validate as va
from ...operators import report as rp
from ...session import settle, shared_dir
from ...sources import history as hs
from ...sources.sinks import read_ledger
from .. import onboard
from ..corpus import LEXICON, SETTINGS, table
from ..publish import publish
from . import passages as psg, sql


def document_passages(spark, sf):
    """Each document row as one passage of its source, in its own language."""
    state = F.element_at(F.array(F.lit("XA"), F.lit("XB"), F.lit("XC")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = table(spark, sf, "documents").select(
        F.col("source").alias("document"), F.col("doc_id").alias("page"), F.col("doc_id").alias("ordinal"), "text",
        state.alias("state_code"), F.lit(None).cast("array<string>").alias("section"), F.lit(False).alias("from_ocr"), "lang")
    return facets.resolve(rows, LEXICON, SETTINGS, F.col("lang"))


ROWS = f"""{sql.lexicon()},
rows_ as (select source as document, doc_id as page, doc_id as ordinal, text, ['XA', 'XB', 'XC'][doc_id % 3 + 1] as state_code,
  cast([] as varchar[]) as section, lang from documents),
{sql.facets().replace("'en' as language", "lang as language")}, {sql.NAMES}"""

KIND = "case when x in ('herd', 'flock') then 'Livestock' else 'Crop' end"
ROLLUP = f"""g as (select resource_id, category, area_code, min_by(state_code, (document, ordinal)) as state_code, count(*) as passage_count,
  min(page) as page_min, max(page) as page_max from facets_ group by 1, 2, 3),
lang_ as (select resource_id, string_agg(language, ',' order by n desc, f) as languages from
  (select resource_id, language, count(*) as n, min((document, ordinal)) as f from facets_ group by 1, 2) group by 1),
u_ as (select resource_id, 's' as t, unnest(subjects) as x from facets_ union all select resource_id, 't', unnest(topics) from facets_
  union all select resource_id, 'w', unnest(weather) from facets_ union all select resource_id, 'a', unnest(also) from facets_),
v_ as (select resource_id, list(distinct x order by x) filter (t = 's') as subjects, list(distinct x order by x) filter (t = 't') as topics,
  list(distinct x order by x) filter (t = 'w') as weather, list(distinct x order by x) filter (t = 'a') as also,
  list(distinct {KIND}) filter (t = 's') as kinds from u_ group by 1),
r_ as (select g.*, languages, coalesce(subjects, []) as subjects, coalesce(topics, []) as topics, coalesce(weather, []) as weather,
  list_concat([area_code], list_filter(coalesce(also, []), lambda c: c <> area_code)) as coverage,
  list_sort(list_distinct(list_concat(coalesce(kinds, []), case category when 'Horticulture' then ['Crop', 'Horticulture'] else [category] end))) as categories,
  category || 'AdvisoryCapability' as capability, 'cat-corpus-field-notes-' || lower(state_code) as catalog_id,
  a.name as area_name, a.level as area_level
  from g join lang_ using (resource_id) left join v_ using (resource_id) join areas_ a on a.code = area_code)"""


def flat(resources):
    j = lambda c: F.array_join(c, ",").alias(c)
    return resources.select(
        "resource_id", "category", "area_code", "passage_count", "page_min", "page_max", "capability", "catalog_id",
        j("languages"), j("subject_slugs"), j("topics"), j("weather_parameters"), j("coverage_codes"), j("subject_categories"))


FLAT = f"""select resource_id, category, area_code, passage_count, page_min, page_max, capability, catalog_id, languages,
 {sql.joined('subjects')} as subject_slugs, {sql.joined('topics')} as topics, {sql.joined('weather')} as weather_parameters,
 {sql.joined('coverage')} as coverage_codes, {sql.joined('categories')} as subject_categories from r_"""


def rollup(spark, sf):
    return flat(res.rollup(document_passages(spark, sf), LEXICON, SETTINGS))


ROLLUP_SQL = f"with {ROWS}, {ROLLUP} {FLAT}"


def corpus_resources(spark, sf):
    """Segmented passages of the whole corpus rolled up: the full path."""
    return flat(res.rollup(psg.extraction(spark, sf).passages, LEXICON, SETTINGS))


CORPUS_SQL = f"{psg.FULL}, {ROLLUP} {FLAT}"


def resource_documents(spark, sf):
    return res.resource_documents(document_passages(spark, sf))


DOCUMENTS_SQL = f"with {ROWS} select resource_id, document, count(*) as passages from facets_ group by 1, 2"


def resources(spark, sf):
    found = settle(document_passages(spark, sf), "passages")
    rolled = res.rollup(found, LEXICON, SETTINGS)
    return res.attributes(rolled, res.resource_documents(found), LEXICON, SETTINGS)


def descriptors(spark, sf):
    return resources(spark, sf).select(
        "resource_id", "descriptor.*", F.col("attributes.evidence.documentCount").alias("documents"))


DESCRIPTOR_SQL = f"""with {ROWS}, {ROLLUP},
d as (select resource_id, count(distinct document) as documents from facets_ group by 1)
select resource_id, upper(category) || '-' || area_code as code, category || ' advisory, ' || area_name as name,
 case category when 'Weather' then 'Weather forecast and warnings' else category || ' advisory' end || ' at ' || lower(area_level)
   || ' granularity for ' || area_name as "shortDesc",
 category || ' advisory capability covering ' || area_name || ', standing on ' ||
   case when passage_count = 1 then '1 indexed passage' else passage_count || ' indexed passages' end || ' (source ' ||
   case when page_min = page_max then 'page ' || page_min else 'pages ' || page_min || '-' || page_max end ||
   '). Advisory text itself is served by the provider node on direct request, not through this catalogue.' as "longDesc", documents
from r_ join d using (resource_id)"""


def capability_counts(spark, sf):
    rolled = res.rollup(document_passages(spark, sf), LEXICON, SETTINGS)
    return res.capability_counts(rolled).withColumn("type", capability_of(F.concat(F.lit("adv:"), F.col("capability"))))


CAPABILITY_SQL = f"with {ROWS}, {ROLLUP} select capability, count(*) as resources, capability as type from r_ group by 1"


def schema_contexts(spark, sf):
    return res.schema_contexts(res.rollup(document_passages(spark, sf), LEXICON, SETTINGS), SETTINGS)


CONTEXT_SQL = f"""with {ROWS}, {ROLLUP} select distinct 'https://schemas.example.org/schema/' || capability
 || '/v0.1/context.jsonld#adv:' || capability as schema_context from r_"""


def catalogue_json(spark, sf):
    """Catalogues as they go on the wire, read back from the JSON."""
    cats = res.catalogs(resources(spark, sf), LEXICON, SETTINGS, F.timestamp_seconds(F.lit(1767225600)))
    body = cats.select("catalog_id", F.to_json("catalog").alias("j"))
    ids = F.from_json(F.get_json_object("j", "$.resources[*].id"), "array<string>")
    return body.select(
        "catalog_id", F.get_json_object("j", "$.provider.id").alias("provider"),
        F.get_json_object("j", "$.validity.endDate").alias("valid_to"), F.array_join(ids, ",").alias("resource_ids"))


JSON_SQL = f"""with {ROWS}, {ROLLUP} select catalog_id, 'prov-corpus' as provider, '2027-01-01T00:00:00Z' as valid_to,
 string_agg(resource_id, ',' order by area_code, category) as resource_ids from r_ group by 1"""


def envelope_shape(spark, sf):
    now = F.timestamp_seconds(F.lit(1767225600))
    cats = res.catalogs(resources(spark, sf), LEXICON, SETTINGS, now)
    env = res.envelope(cats, SETTINGS, transaction_id="t-1", message_id="m-1", now=now)
    return env.select(
        F.col("context.version").alias("version"), F.col("context.timestamp").alias("timestamp"),
        F.size("message.catalogs").alias("catalogs"),
        F.array_join("message.publishDirectives.catalogId", ",").alias("directives"),
        F.array_join("context.schemaContext", ",").alias("contexts"))


ENVELOPE_SQL = f"""with {ROWS}, {ROLLUP}, c as (select string_agg(x, ',' order by x) as contexts from (select distinct
 'https://schemas.example.org/schema/' || capability || '/v0.1/context.jsonld#adv:' || capability as x from r_))
select '2.0.0' as version, '2026-01-01T00:00:00Z' as timestamp, cast(count(distinct catalog_id) as integer) as catalogs,
 string_agg(distinct catalog_id, ',' order by catalog_id) as directives, (select contexts from c) as contexts from r_"""


def published(spark, sf):
    return pb.published_rows(settle(resources(spark, sf), "resources"), SETTINGS)


def facet_index(spark, sf):
    return dc.facet_index(published(spark, sf))


INDEX_SQL = f"""with {ROWS}, {ROLLUP}
select count(*) as resources, (select count(distinct x) from (select unnest(subjects) as x, category from r_) where category <> 'Weather') as subject_uris,
 (select count(distinct x) from (select unnest(coverage) as x from r_)) as area_codes,
 (select count(distinct x) from (select unnest(topics) as x from r_)) as topics,
 (select count(distinct x) from (select unnest(categories) as x from r_)) as subject_categories,
 (select count(distinct x) from (select unnest(weather) as x from r_)) as weather_parameters,
 (select count(distinct x) from (select unnest(string_split(languages, ',')) as x from r_)) as languages from r_"""


def discover(spark, sf):
    hits = dc.discover(published(spark, sf), area_code="XC-ERTH", language="en", limit=7)
    return hits.select("resource_id", "catalog_id", "provider_id", "score", F.array_join("matched_on", ",").alias("matched_on"),
                       F.array_join("languages", ",").alias("languages"), F.array_join("area_codes", ",").alias("area_codes"))


DISCOVER_SQL = f"""with {ROWS}, {ROLLUP} select resource_id, catalog_id, 'prov-corpus' as provider_id,
 cast(3 + (area_level = 'District')::integer as integer) as score, 'area,language' as matched_on, languages,
 {sql.joined('coverage')} as area_codes from r_ where list_contains(coverage, 'XC-ERTH') and list_contains(string_split(languages, ','), 'en')
order by score desc, resource_id limit 7"""


def discover_subject(spark, sf):
    uri = f"{SETTINGS.taxonomy_base}/crop/thin"
    return dc.discover(published(spark, sf), subject_uri=uri, capability="HorticultureAdvisoryCapability", limit=None).select(
        "resource_id", "score")


SUBJECT_SQL = f"""with {ROWS}, {ROLLUP} select resource_id, cast(3 + (area_level = 'District')::integer as integer) as score from r_
where list_contains(subjects, 'thin') and category = 'Horticulture'"""


def leak_probe(spark, sf):
    return dc.leaks(published(spark, sf), ["Erth", "moisture stress", "XAVIA", "src1"])


LEAK_SQL = f"""with {ROWS}, {ROLLUP},
n as (select resource_id, lower(string_agg(a.name || ' ' || a.code, ' ')) as names, any_value(lower(subj)) as subj from
  (select resource_id, unnest(coverage) as c, {sql.joined('subjects')} as subj from r_) x join areas_ a on a.code = x.c group by 1)
select 'Erth' as probe, count(*) filter (contains(names, 'erth') or contains(subj, 'erth')) as resources from n
union all select 'moisture stress', 0
union all select 'XAVIA', count(*) filter (contains(names, 'xavia')) from n
union all select 'src1', 0"""


_AREA = "array<struct<codeScheme:string,areaCode:string,areaLevel:string,areaName:string>>"
_SUBJECT = "array<struct<subjectId:string,subjectType:string,descriptor:struct<code:string,name:string>>>"
# fault -> (attribute, its faulty value in Spark SQL, which resources in SQL, rules and details found)
FAULTS = {
    "context": ("@context", "' '", "true", [("blank-context", "'@context'")]),
    "type": ("@type", "''", "true", [("blank-type", "'@type'"), ("unknown-type", "''")]),
    "odd-type": ("@type", "'adv:Nonsense'", "true", [("unknown-type", "'adv:Nonsense'")]),
    "coverage": ("coverageAreas", f"cast(array() as {_AREA})", "true", [("no-coverage", "'coverageAreas'")]),
    "area": ("coverageAreas", f"from_json('[{{\"areaLevel\":\"State\",\"areaName\":\"Nowhere\"}}]', '{_AREA}')", "true",
             [("area-incomplete", "'Nowhere'"), ("unknown-scheme", "'null'"), ("unknown-area", "'null'")]),
    "odd-area": ("coverageAreas", f"from_json('[{{\"codeScheme\":\"S\",\"areaCode\":\"Z\",\"areaLevel\":\"Village\"}}]', '{_AREA}')",
                 "true", [("unknown-scheme", "'S'"), ("unknown-level", "'Village'"), ("unknown-area", "'Z'")]),
    "languages": ("languages", "cast(array() as array<string>)", "true", [("no-language", "'languages'")]),
    "language": ("languages", "array('eng')", "category = 'Crop'", [("bad-language", "'eng'")]),
    "subjects": ("agricultureSubjects", f"from_json('[{{\"subjectId\":\"x\",\"subjectType\":\"Fish\"}}]', '{_SUBJECT}')",
                 "category = 'Crop'", [("undeclared-subject-type", "'Fish'"), ("unminted-subject", "'x'")]),
    "topic": ("topics", "array('Bogus')", "category = 'Weather'", [("unknown-topic", "'Bogus'")]),
    "weather": ("weatherParameters", "array('Bogus')", "category = 'Weather'", [("unknown-weather", "'Bogus'")]),
    "foreign": ("weatherParameters", "array('Mist')", "category = 'Livestock'", [("foreign-group", "'weatherParameters'")]),
    "granularity": ("geographicGranularity", "'Village'", "true", [("bad-granularity", "'Village'")]),
    "frequency": ("updateFrequency", "'P'", "category = 'Horticulture'", [("bad-duration", "'P'")]),
    "horizon": ("forecastHorizon", "'P1H'", "category = 'Weather'", [("bad-duration", "'P1H'")]),
    "horizon-of-many-parts": ("forecastHorizon", "'P1D2D3D4D5D6D7D8D9DT1H1M1S1H1M1S1H'", "true", []),
}
CATEGORIES = ("array_union(attributes.subjectCategories, array('Fish'))", "unknown-category", "Fish")
SOUND = '{"sprayWindow": "P1D", "note": "coordinates", "place": {"coordinates": [1, 2]}}'
UNSOUND = '{"note": {"text": ["spray 4 ml/l of it"]}, "coverageAreas": [{"areaCode": "a", "coordinates": [1, 2]}]}'


def violations(spark, sf):
    """Every rule about resources meets its fault, on copies of the resources that are told apart by `catalog_id`;
    then the rules about catalogues, envelopes and directives."""
    sound = settle(resources(spark, sf), "resources")
    names = [*FAULTS, "category", "none", "advice", "extras", "sound"]
    copies = sound.withColumn("catalog_id", F.explode(F.array(*map(F.lit, names))))
    fault = F.col("catalog_id")
    def faulty(field):
        value = F.col(f"attributes.`{field}`")
        for name, (at, wrong, where, _) in FAULTS.items():
            if at == field:
                value = F.when((fault == name) & F.expr(where), F.expr(wrong)).otherwise(value)
        if field == "subjectCategories":
            value = F.when(fault == "category", F.expr(CATEGORIES[0])).otherwise(value)
        return value.alias(field)

    changed = F.struct(*[faulty(f) for f in sound.schema["attributes"].dataType.fieldNames()])
    seeded = copies.withColumns({
        "attributes": F.when(fault != "none", changed),
        "descriptor": F.col("descriptor").withField(
            "shortDesc", F.when(fault == "advice", "Spray it").otherwise(F.col("descriptor.shortDesc"))),
        "extras": F.when(fault == "extras", UNSOUND).when(fault == "sound", SOUND),
    })
    found = va.resource_violations(seeded, LEXICON, SETTINGS)
    now = F.timestamp_seconds(F.lit(1767225600))
    cats = settle(res.catalogs(sound, LEXICON, SETTINGS, now), "catalogs")
    env = settle(res.envelope(cats, SETTINGS, transaction_id="", message_id="m-1", now=now), "envelope")
    bad_env = env.withColumn("context", F.col("context").withField("version", F.lit("1.0")).withField("action", F.lit("send"))
                             .withField("extraKey", F.lit("x")))
    bad_cat = cats.withColumn("catalog", F.col("catalog").withField("provider.id", F.lit("")).withField(
        "descriptor", F.lit(None)).withField("resources", F.slice("catalog.resources", 1, 0)))
    twice = va.duplicate_ids(sound.unionByName(sound)).select(
        "catalog_id", "resource_id", F.lit("duplicate-id").alias("rule"), F.col("n").cast("string").alias("detail"))
    told = spark.createDataFrame([("cat-other", "BOGUS")], "catalog_id string, catalog_type string")
    parts = [va.context_violations(bad_env), va.closed_object_violations(bad_env), va.catalog_violations(bad_cat), twice,
             va.directive_violations(sound.select("catalog_id"), told)]
    for p in parts:
        found = found.unionByName(p)
    return found


def _seeded() -> str:
    rows = [f"select '{name}' as catalog_id, resource_id, '{rule}' as rule, {detail} as detail from r_ where {where}"
            for name, (_, _, where, found) in FAULTS.items() for rule, detail in found]
    rows += [f"select 'category', resource_id, '{CATEGORIES[1]}', '{CATEGORIES[2]}' from r_",
             "select 'none', resource_id, 'no-attributes', '' from r_",
             "select 'advice', resource_id, 'advice-in-descriptor', 'descriptor.shortDesc' from r_",
             "select 'extras', resource_id, 'prose', 'resourceAttributes.note.text[0] = spray 4 ml/l of it' from r_",
             "select 'extras', resource_id, 'coordinates', 'coordinates' from r_",
             "select null, null, 'bad-version', '1.0'", "select null, null, 'bad-action', 'send'",
             "select null, null, 'missing-context', 'transactionId'", "select null, null, 'unknown-key', 'extraKey'",
             "select catalog_id, null, 'no-resources', 'resources' from c_", "select catalog_id, null, 'no-provider', 'provider.id' from c_",
             "select catalog_id, null, 'no-descriptor', 'descriptor' from c_",
             "select catalog_id, resource_id, 'duplicate-id', '2' from r_", "select catalog_id, null, 'no-directive', catalog_id from c_",
             "select 'cat-other', null, 'bad-catalog-type', 'BOGUS'"]
    return "\nunion all ".join(rows)


VIOLATION_SQL = f"""with {ROWS}, {ROLLUP}, c_ as (select distinct catalog_id from r_)
{_seeded()}"""


def publish_round_trip(spark, sf):
    """What differs between the resources and a node that lost some and holds others in an older form, before and
    after they are published into it. What the node alone has stays."""
    sent = settle(resources(spark, sf), "resources")
    own = pb.published_rows(sent, SETTINGS)
    kind = F.split("resource_id", "-")[4]
    older = F.col("attributes").withField("languages", F.array(F.lit("xx")))
    before = own.where(kind != "crop").withColumn("attributes", F.when(kind == "weather", older).otherwise(F.col("attributes")))
    before = settle(before.unionByName(own.withColumn("resource_id", F.concat(F.lit("gone-"), "resource_id"))), "held")
    after = settle(pb.publish_into(before, sent, SETTINGS), "held")
    return (dc.round_trip(own, before).withColumn("stage", F.lit("before"))
            .unionByName(dc.round_trip(own, after).withColumn("stage", F.lit("after")))
            .unionByName(after.select("resource_id", F.lit("held").alias("problem"), F.lit("after").alias("stage"))))


TRIP_SQL = f"""with {ROWS}, {ROLLUP}
select resource_id, case category when 'Crop' then 'not held' else 'differs' end as problem, 'before' as stage from r_
 where category in ('Crop', 'Weather')
union all select resource_id, 'held', 'after' from r_ union all select 'gone-' || resource_id, 'held', 'after' from r_"""


def publish_ledger(spark, sf):
    """Three publishes into one kept table: all, all again, and the resources of one state alone."""
    folder = f"{shared_dir(spark)}/node-{uuid.uuid4().hex}"
    every = settle(resources(spark, sf), "resources")
    for sent in (every, every, settle(every.where("state_code = 'XA'"), "resources")):
        publish(spark, sent, LEXICON, SETTINGS, table=f"{folder}/node", ledger=f"{folder}/ledger")
    return read_ledger(spark, f"{folder}/ledger").select(
        "seq", "target", "ack_status", "resources", "changed_since_previous", F.array_join("catalog_ids", ",").alias("catalogs"))


PUBLISH_LEDGER_SQL = f"""with {ROWS}, {ROLLUP}, p as (
 select 1 as seq, cast(null as boolean) as changed_since_previous, * from r_ union all select 2, false, * from r_
 union all select 3, true, * from r_ where state_code = 'XA')
select cast(seq as bigint) as seq, 'kept table' as target, 'ACCEPTED' as ack_status, count(*) as resources, changed_since_previous,
 string_agg(distinct catalog_id, ',' order by catalog_id) as catalogs from p group by seq, changed_since_previous"""


def claims_hash(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    body = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    return pb.claims_hash(o.join(c, o["o_custkey"] == c["c_custkey"]), body, "c_nationkey")


_LANE = "sum(cast('0x' || substr(h, {}, 15) as hugeint))"
CLAIMS_SQL = f"""with h as (select c_nationkey, sha256(o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority) as h
 from orders join customer on o_custkey = c_custkey)
select c_nationkey, sha256(count(*) || '|' || {" || '|' || ".join(_LANE.format(1 + 15 * i) for i in range(4))}) as claims_hash
from h group by 1"""


INSTANTS = tuple(f"2026-0{i}-01 00:00:00" for i in (1, 2, 3))


def _claims(spark, sf):
    """Three publishes of orders as claims: two thirds of them; all, with other priorities for some; and all that
    were sent before but for one in seven."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_nationkey", "o_orderstatus", "o_orderpriority")
    first = rows.where("o_orderkey % 3 <> 0")
    second = rows.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, "9-NEW").otherwise(F.col("o_orderpriority")))
    return first, second, second.where("o_orderkey % 7 <> 0")


_SENT = """rows_ as (select o_orderkey, c_nationkey, o_orderstatus, o_orderpriority from orders join customer on o_custkey = c_custkey),
late_ as (select * replace (case when o_orderkey % 5 = 0 then '9-NEW' else o_orderpriority end as o_orderpriority) from rows_)"""


def _recorded(spark, sf):
    """The history of the three publishes, each of which stands for all claims of the nations that it names."""
    path = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    for rows, at in zip(_claims(spark, sf), INSTANTS):
        hs.record(spark, path, rows, at, "o_orderkey", scope="c_nationkey")
    return hs.read(spark, path)


def node_as_of(spark, sf):
    """What was claimed on three days, each between two publishes or after the last."""
    history = settle(_recorded(spark, sf), "history")
    days = ("2026-01-15", "2026-02-01", "2026-12-31")
    states = [hs.as_of(history, d).withColumn("day", F.lit(d)) for d in days]
    return reduce(lambda a, b: a.unionByName(b), states).select("day", "o_orderkey", "o_orderstatus", "o_orderpriority")


AS_OF_SQL = f"""with {_SENT} select '2026-01-15' as day, o_orderkey, o_orderstatus, o_orderpriority from rows_ where o_orderkey % 3 <> 0
union all select '2026-02-01', o_orderkey, o_orderstatus, o_orderpriority from late_
union all select '2026-12-31', o_orderkey, o_orderstatus, o_orderpriority from late_ where o_orderkey % 7 <> 0"""


def change_feed(spark, sf):
    """What each publish added, changed and removed."""
    return hs.feed(_recorded(spark, sf)).groupBy(F.date_format("at", "yyyy-MM-dd").alias("day"), "change").agg(F.count("*").alias("n"))


FEED_SQL = f"""with {_SENT}, c as (
 select '2026-01-01' as day, 'added' as change from rows_ where o_orderkey % 3 <> 0
 union all select '2026-02-01', 'added' from rows_ where o_orderkey % 3 = 0
 union all select '2026-02-01', 'changed' from rows_ where o_orderkey % 3 <> 0 and o_orderkey % 5 = 0
 union all select '2026-03-01', 'removed' from rows_ where o_orderkey % 7 = 0) select day, change, count(*) as n from c group by 1, 2"""


def claims_hash_incremental(spark, sf):
    """Claims hashes after three publishes, kept up to date by what each of them changed."""
    sums = None
    for change in hs.batches(_recorded(spark, sf), INSTANTS):
        sums = settle(hs.moved_sums(sums, change, "c_nationkey"), "sums")
    return pb.hash_of(sums)


CLAIMS_MOVED_SQL = f"""with {_SENT}, h as (select c_nationkey, sha256(cast(to_json({{'o_orderkey': o_orderkey, 'c_nationkey': c_nationkey,
 'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority}}) as varchar)) as h from late_ where o_orderkey % 7 <> 0)
select c_nationkey, sha256(count(*) || '|' || {" || '|' || ".join(_LANE.format(1 + 15 * i) for i in range(4))}) as claims_hash
from h group by 1"""


def facet_index_incremental(spark, sf):
    """The facet index after publishes that added, changed and removed resources, from counts that follow the changes."""
    path = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    own = settle(published(spark, sf), "published")
    older = own.withColumn("attributes", F.col("attributes").withField("languages", F.array(F.lit("xx"))))
    for rows, at in zip((older.where("state_code <> 'XC'"), own, own.where("resource_id not like '%weather%'")), INSTANTS):
        hs.record(spark, path, rows, at, "resource_id", scope="provider_id")
    counts = None
    for change in hs.batches(hs.read(spark, path), INSTANTS):
        counts = settle(hs.moved_counts(counts, change), "counts")
    return dc.facet_index_of(counts)


FACETS_MOVED_SQL = INDEX_SQL.replace(f"with {ROWS}, {ROLLUP}", f"with {ROWS}, {ROLLUP.replace('r_ as (select g.*', 'all_ as (select g.*')}, r_ as (select * from all_ where category <> 'Weather')")


def ledger_changes(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", F.floor("value").cast("string").alias("claims_hash"))
    return pb.mark_changes(e, "event_type", order="event_id").select("event_id", "changed_since_previous")


LEDGER_SQL = """with e as (select event_type, event_id, cast(floor(value) as bigint)::varchar as h from events)
select event_id, h <> lag(h) over (partition by event_type order by event_id) as changed_since_previous from e"""


def ledger_retention(spark, sf):
    return pb.retain(table(spark, sf, "events").select("event_id", "user_id"), SETTINGS, "event_id")


RETENTION_SQL = "select event_id, user_id from events order by event_id desc limit 200"


def acknowledgements(spark, sf):
    return pb.fold_statuses(table(spark, sf, "orders"), "o_custkey", status="o_orderstatus")


ACK_SQL = """select o_custkey, case when count(o_orderstatus) = 0 then 'ACCEPTED' when count(distinct o_orderstatus) > 1 then 'PARTIAL'
 else min(o_orderstatus) end as status from orders group by 1"""


def payload_bytes(spark, sf):
    size = pb.json_bytes(F.struct("doc_id", "text", "source"))
    return table(spark, sf, "documents").groupBy("source").agg(F.sum(size).alias("bytes"))


BYTES_SQL = """select source, cast(sum(octet_length(encode(cast(to_json({'doc_id': doc_id, 'text': text, 'source': source}) as varchar)))) as bigint) as bytes
from documents group by 1"""


def run_totals(spark, sf):
    e = psg.extraction(spark, sf)
    rolled = onboard.catalogue(e, LEXICON, SETTINGS)
    return rp.run_totals(e.decisions, e.passages, rolled).drop("attributes_bytes")


TOTALS_SQL = f"""{psg.FULL}, o as (select count(*) filter (state_code is not null and usable > 0 and usable / pages >= 0.5) as ok, count(*) as n
  from gate_ join states_ using (document))
select (select ok from o) as onboarded, (select n - ok from o) as refused, cast(0 as bigint) as failed, count(*) as passages,
 count(distinct resource_id) as resources from facets_"""


def id_drift(spark, sf):
    """Ids of all passages against a roll-up of the English ones alone."""
    found = settle(document_passages(spark, sf), "passages")
    rolled = res.rollup(found.where("language = 'en'"), LEXICON, SETTINGS)
    return res.id_drift(found, rolled)


DRIFT_SQL = f"""with {ROWS} select resource_id, 'passages' as only_in from facets_ group by 1 having count(*) filter (language = 'en') = 0"""

QUERIES = {
    "resource_rollup": (rollup, ROLLUP_SQL),
    "corpus_resources": (corpus_resources, CORPUS_SQL),
    "resource_documents": (resource_documents, DOCUMENTS_SQL),
    "publish_round_trip": (publish_round_trip, TRIP_SQL),
    "publish_ledger": (publish_ledger, PUBLISH_LEDGER_SQL),
    "descriptor_text": (descriptors, DESCRIPTOR_SQL),
    "capability_counts": (capability_counts, CAPABILITY_SQL),
    "schema_contexts": (schema_contexts, CONTEXT_SQL),
    "catalogue_json": (catalogue_json, JSON_SQL),
    "envelope_shape": (envelope_shape, ENVELOPE_SQL),
    "facet_index": (facet_index, INDEX_SQL),
    "discover_topk": (discover, DISCOVER_SQL),
    "discover_by_subject": (discover_subject, SUBJECT_SQL),
    "leak_probe": (leak_probe, LEAK_SQL),
    "validation_violations": (violations, VIOLATION_SQL),
    "claims_hash": (claims_hash, CLAIMS_SQL),
    "claims_hash_incremental": (claims_hash_incremental, CLAIMS_MOVED_SQL),
    "node_as_of": (node_as_of, AS_OF_SQL),
    "change_feed": (change_feed, FEED_SQL),
    "facet_index_incremental": (facet_index_incremental, FACETS_MOVED_SQL),
    "ledger_changes": (ledger_changes, LEDGER_SQL),
    "ledger_retention": (ledger_retention, RETENTION_SQL),
    "ack_status_fold": (acknowledgements, ACK_SQL),
    "payload_bytes": (payload_bytes, BYTES_SQL),
    "run_totals": (run_totals, TOTALS_SQL),
    "resource_id_drift": (id_drift, DRIFT_SQL),
}
