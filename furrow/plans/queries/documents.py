"""Page gates, ordered operations and table-level checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.text import stripped_length
from ...operators import discover as dc, pages as pg, validate as va, vector_index as vi
from ...operators.facets import choose_area
from ...operators.ordered import first_per, running
from .. import corpus
from ..corpus import SETTINGS, table
from . import sql


def line_pages(spark, sf):
    """Lines of a source as its pages, for the page gates."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("document"), F.posexplode(F.split("text", "\n")).alias("page", "text"),
        (F.col("doc_id") % 7 == 0).alias("ocr"))


LINE_PAGES = """lp as (select source as document, doc_id % 7 = 0 as ocr, unnest(string_split(text, chr(10))) as text from documents),
n as (select *, length(trim(text)) as n from lp)"""


def scan_gate(spark, sf):
    return pg.scan_gate(line_pages(spark, sf), SETTINGS).withColumn("usable_ratio", F.round("usable_ratio", 9))


GATE_SQL = f"""with {LINE_PAGES}, g as (select document, count(*) as pages, count(*) filter (n >= 40) as usable_pages from n group by 1)
select *, round(usable_pages / pages, 9) as usable_ratio, usable_pages > 0 and usable_pages / pages >= 0.5 as readable from g"""


def thin_pages(spark, sf):
    return pg.thin_report(line_pages(spark, sf), SETTINGS)


THIN_SQL = f"""with {LINE_PAGES}, g as (select document, count(*) as pages, cast(sum(length(text)) as bigint) as char_count,
 count(*) filter (ocr) as ocr_pages, count(*) filter (not ocr and n >= 40 and n < 150) as thin_pages,
 count(*) filter (n < 40) as empty_pages from n group by 1)
select *, thin_pages + empty_pages as unread_pages,
 thin_pages + empty_pages > 0 and (thin_pages + empty_pages) / pages >= 0.4 as thin_warning from g"""


def picture_pages(spark, sf):
    text = F.regexp_replace("html", "<[^>]*>", "")
    image = F.col("html").contains('class="ad"')
    return table(spark, sf, "pages").select(
        "page_id", pg.is_picture(text, image, SETTINGS).alias("picture"), stripped_length(text).alias("chars"))


PICTURE_SQL = f"""with t as (select page_id, html, length({sql.strip("regexp_replace(html, '<[^>]*>', '', 'g')")}) as n from pages)
select page_id, contains(html, 'class="ad"') and n < 150 as picture, cast(n as integer) as chars from t"""


def state_detection(spark, sf):
    return pg.state_of(corpus.pages(spark, sf), corpus.LEXICON)


STATE_SQL = f"with {sql.PAGES}, {sql.STATE} select document, state_code from states_"


def line_ordinals(spark, sf):
    """Running number of the lines of a source, over all its pages."""
    per_page = table(spark, sf, "documents").select("source", "doc_id", F.split("text", "\n").alias("kept"))
    counted = per_page.withColumn("n", F.size("kept").cast("long"))
    placed = running(counted, "source", "doc_id", chunk=SETTINGS.page_chunk, totals={"n": "before"})
    return placed.select("source", "doc_id", "before", F.posexplode("kept").alias("i", "line")).select(
        "source", "doc_id", (F.col("before") + F.col("i")).alias("ordinal"), F.length("line").alias("chars"))


ORDINAL_SQL = """with l as (select source, doc_id, unnest(string_split(text, chr(10))) as line,
  unnest(range(len(string_split(text, chr(10))))) as i from documents)
select source, doc_id, row_number() over (partition by source order by doc_id, i) - 1 as ordinal,
  cast(length(line) as integer) as chars from l"""


def section_fill(spark, sf):
    """The last heading page of each source, carried to later pages."""
    head = F.when(F.col("text").rlike("^(The|Que|Und|A) "), F.col("doc_id"))
    rows = table(spark, sf, "documents").select("source", "doc_id", head.alias("heading"))
    return running(rows, "source", "doc_id", chunk=SETTINGS.page_chunk, fill={"heading": "section"}).select(
        "source", "doc_id", "section")


FILL_SQL = """with d as (select source, doc_id, case when regexp_matches(text, '^(The|Que|Und|A) ') then doc_id end as h from documents)
select source, doc_id, last_value(h ignore nulls) over (partition by source order by doc_id
  rows between unbounded preceding and current row) as section from d"""


def conversation_sections(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("head", F.when(F.col("role") == "user", F.col("turn")))
    return running(rows, "conv_id", "turn", chunk=SETTINGS.page_chunk, fill={"head": "asked"},
                   totals={"turn": "before"}).select("conv_id", "turn", "asked", "before")


CONVERSATION_SQL = """select conv_id, turn,
 last_value(case when role = 'user' then turn end ignore nulls) over w as asked,
 cast(coalesce(sum(turn) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as bigint) as before
from conversations window w as (partition by conv_id order by turn rows between unbounded preceding and current row)"""


def first_per_role(spark, sf):
    rows = first_per(table(spark, sf, "conversations"), ["conv_id", "role"], [F.col("turn")])
    return rows.select("conv_id", "role", "turn", F.length("text").alias("chars"))


FIRST_SQL = """select conv_id, role, turn, cast(length(text) as integer) as chars from conversations
qualify row_number() over (partition by conv_id, role order by turn) = 1"""


def area_choice(spark, sf):
    """Primary area and further coverage of customers, from lists of nation codes."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    code = lambda k: F.concat(F.lit("N"), k.cast("string"))
    section = F.when(F.col("c_custkey") % 3 == 0, F.array(code(F.col("c_nationkey")), code(F.col("c_custkey") % 5)))
    named = F.when(F.col("c_custkey") % 2 == 0, F.array(code(F.col("c_custkey") % 7))).otherwise(
        F.array(code(F.col("c_custkey") % 5), code(F.col("c_custkey") % 5 + 10)))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    state = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    primary, rest = choose_area(section, named, state)
    return rows.select("c_custkey", primary.alias("area"), F.array_join(rest, ",").alias("also"))


AREA_SQL = """with r as (select c_custkey, 'R' || n_regionkey as state,
  case when c_custkey % 3 = 0 then ['N' || c_nationkey, 'N' || (c_custkey % 5)] else [] end as section,
  case when c_custkey % 2 = 0 then ['N' || (c_custkey % 7)] else ['N' || (c_custkey % 5), 'N' || (c_custkey % 5 + 10)] end as named
  from customer join nation on c_nationkey = n_nationkey),
p as (select *, case when len(section) > 0 then section[1] when len(named) = 1 then named[1] else state end as area,
  case when len(section) > 0 then list_concat(section[2:], named) when len(named) = 1 then [] else named end as also0 from r)
select c_custkey, area, array_to_string(list_filter(also0, lambda x, i: x <> area and list_position(also0, x) = i), ',') as also from p"""


AREAS = "array<struct<codeScheme:string,areaCode:string,areaLevel:string,areaName:string>>"
SUBJECTS = "array<struct<subjectId:string,subjectType:string,descriptor:struct<code:string,name:string>>>"


def as_resources(rows, key, **own):
    """Rows of a table as resources, with the given attributes and plain ones else."""
    null = lambda kind: F.lit(None).cast(kind)
    plain = {
        "@context": F.lit("x"), "@type": F.lit("adv:CropAdvisoryCapability"), "subjectCategories": F.array(F.lit("Crop")),
        "languages": F.array(F.lit("en")), "coverageAreas": null(AREAS), "geographicGranularity": F.lit("State"),
        "agricultureSubjects": null(SUBJECTS), "weatherParameters": null("array<string>"), "topics": null("array<string>"),
        "updateFrequency": F.lit("P1D"), "forecastHorizon": null("string")}
    return rows.select(
        F.lit("c").alias("catalog_id"), F.col(key).cast("string").alias("resource_id"),
        F.struct(*[v.alias(k) for k, v in {**plain, **own}.items()]).alias("attributes"),
        F.struct(*[F.lit("n").alias(k) for k in ("code", "name", "shortDesc", "longDesc")]).alias("descriptor"))


def violations_of(resources, rule):
    found = va.resource_violations(resources, corpus.LEXICON, SETTINGS)
    return found.where(F.col("rule") == rule).select("resource_id", "detail")


def closed_vocabulary(spark, sf):
    """Events as resources; clicks, views and purchases are known topics, other types are not."""
    kind = F.col("event_type")
    topic = F.when(kind == "click", "Reading").when(kind == "view", "Holding").when(kind == "purchase", "Rare").otherwise(kind)
    return violations_of(as_resources(table(spark, sf, "events"), "event_id", topics=F.array(topic)), "unknown-topic")


VOCABULARY_SQL = """select cast(event_id as varchar) as resource_id, event_type as detail from events
where event_type not in ('click', 'view', 'purchase')"""


def undeclared_types(spark, sf):
    """Part types a brand carries without declaring them; three are declared."""
    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_set("p_type").alias("types"))
    carried = F.transform("types", lambda t: F.struct(
        F.lit("u").alias("subjectId"), t.alias("subjectType"),
        F.lit(None).cast("struct<code:string,name:string>").alias("descriptor")))
    declared = F.array(F.lit("ECONOMY"), F.lit("SMALL"), F.lit("PROMO"))
    return violations_of(as_resources(brands, "p_brand", agricultureSubjects=carried, subjectCategories=declared),
                         "undeclared-subject-type")


UNDECLARED_SQL = """select p_brand as resource_id, string_agg(distinct p_type, ',' order by p_type) as detail from part
where p_type not in ('ECONOMY', 'SMALL', 'PROMO') group by 1"""


def directive_anti_join(spark, sf):
    """Users are catalogues, orders their directives: users without one, and directives of an open type."""
    users = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("catalog_id"))
    status = F.col("o_orderstatus")
    directives = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("catalog_id"),
        F.when(status == "F", "REGULAR").when(status == "O", "MASTER").otherwise(status).alias("catalog_type"))
    return va.directive_violations(users, directives).select("catalog_id", "rule", "detail")


DIRECTIVE_SQL = """select cast(user_id as varchar) as catalog_id, 'no-directive' as rule, cast(user_id as varchar) as detail
from (select distinct user_id from events) where user_id not in (select o_custkey from orders)
union all select cast(o_custkey as varchar), 'bad-catalog-type', o_orderstatus from orders where o_orderstatus not in ('F', 'O')"""


def duplicate_ids(spark, sf):
    """Texts that stand more than once in one source. Grouped by digest, so the
    shuffle carries no text."""
    rows = table(spark, sf, "documents").select(F.col("source").alias("catalog_id"), F.sha2("text", 256).alias("resource_id"))
    return va.duplicate_ids(rows)


DUPLICATE_SQL = """select source as catalog_id, sha256(text) as resource_id, count(*) as n from documents
group by 1, 2 having count(*) > 1"""


def round_trip(spark, sf):
    """Orders against a copy that lost the urgent ones and changed the pending ones."""
    o = table(spark, sf, "orders")
    held = o.where("o_orderpriority <> '1-URGENT'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit("X")).otherwise(F.col("o_orderstatus")))
    return dc.round_trip(o, held, "o_orderkey", "o_orderstatus")


TRIP_SQL = """select o_orderkey, case when o_orderpriority = '1-URGENT' then 'not held' else 'differs' end as problem
from orders where o_orderpriority = '1-URGENT' or o_orderstatus = 'P'"""


def text_probe(spark, sf):
    return dc.contains_text(table(spark, sf, "documents"), "Apache").select("doc_id", "source")


PROBE_SQL = "select doc_id, source from documents where contains(lower(text), 'apache')"


def upsert_events(spark, sf):
    """A user's newest browsing is held, all other events come in late: the newest of both stays, on either side."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    browsing, order = F.col("event_type").isin("click", "view"), [F.desc("event_id")]
    return vi.upsert(first_per(e.where(browsing), ["user_id"], order), e.where(~browsing), ["user_id"], order)


UPSERT_SQL = """select user_id, event_type, event_id, value from events
qualify row_number() over (partition by user_id order by event_id desc) = 1"""

QUERIES = {
    "scan_gate": (scan_gate, GATE_SQL),
    "thin_page_report": (thin_pages, THIN_SQL),
    "picture_page_predicate": (picture_pages, PICTURE_SQL),
    "state_detection": (state_detection, STATE_SQL),
    "line_ordinals": (line_ordinals, ORDINAL_SQL),
    "section_forward_fill": (section_fill, FILL_SQL),
    "section_on_conversations": (conversation_sections, CONVERSATION_SQL),
    "first_per_code": (first_per_role, FIRST_SQL),
    "area_choice": (area_choice, AREA_SQL),
    "closed_vocabulary": (closed_vocabulary, VOCABULARY_SQL),
    "undeclared_types": (undeclared_types, UNDECLARED_SQL),
    "directive_anti_join": (directive_anti_join, DIRECTIVE_SQL),
    "duplicate_ids": (duplicate_ids, DUPLICATE_SQL),
    "round_trip_diff": (round_trip, TRIP_SQL),
    "contains_text_probe": (text_probe, PROBE_SQL),
    "upsert_latest_wins": (upsert_events, UPSERT_SQL),
}
