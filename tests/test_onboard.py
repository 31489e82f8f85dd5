import json

import pytest
from pyspark.sql import functions as F

from furrow.operators import facets, resources as res, validate as va
from furrow.operators import discover as dc
from furrow.operators.facets import choose_area
from furrow.plans import onboard

PAD = " The field should be looked at again before the end of the week by whoever works on it."
HEAD = "Agromet advisory bulletin for {} districts"


@pytest.fixture(scope="module")
def bulletins():
    return {
        "alphaland_b1.pdf": [
            "Alphaland weekly note. Lentil stands well." + PAD,
            HEAD.format("North Hill/Riverbend") + "\nTomato and onion need care." + PAD,
            "Barley may be sown now." + PAD,
            "Riverbend saw rain, Lakeside saw none." + PAD + "\n" + HEAD.format("Lakeside"),
            "Goat sheds must be dry and lentil straw is useful." + PAD,
            "Animals want shade." + PAD,
        ],
        "zones_b2.pdf": ["Betaland zone table: Kota, Bundi and Jalore expect rain." + PAD, "Only Kota has lentil." + PAD],
        "betaland_b3.pdf": ["बसरोही बकरी का पता नहीं है और टमाटर को पानी दें " * 3 + " betaland", "लिखावट " * 20],
        "thin_b6.pdf": ["Alphaland 12"],
        "nowhere_b7.pdf": ["No state is named here at all." + PAD],
        "alphaland_b9.pdf": ["Alphaland says only this and no more, it is short."],
    }


@pytest.fixture(scope="module")
def got(spark, lexicon, settings, make_pages, bulletins):
    return onboard.extract(make_pages(bulletins), lexicon, settings)


@pytest.fixture(scope="module")
def rows(got):
    out = {}
    for r in got.passages.orderBy("document", "ordinal").collect():
        out.setdefault(r["document"], []).append(r)
    return out


def test_outcomes_keep_refusal_and_failure_apart(got):
    by = {r["document"]: (r["status"], r["reason"]) for r in got.decisions.collect()}
    assert by["thin_b6.pdf"][0] == "refused" and "text layer" in by["thin_b6.pdf"][1]
    assert by["nowhere_b7.pdf"] == ("refused", "names no known state")
    assert by["alphaland_b9.pdf"] == ("failed", "no passages extracted")
    assert by["alphaland_b1.pdf"][0] == by["zones_b2.pdf"][0] == by["betaland_b3.pdf"][0] == "ok"


def test_sections_carry_over_pages_and_last_heading_governs_the_page(rows):
    b1 = rows["alphaland_b1.pdf"]
    assert [r["ordinal"] for r in b1] == list(range(len(b1)))
    by_page = {r["page"]: r for r in b1}
    assert by_page[1]["area"]["code"] == "IN-AA" and by_page[1]["category"] == "Crop"
    assert by_page[2]["area"]["code"] == "IN-AA-NORTH-HILL"
    assert [a["code"] for a in by_page[2]["also_covers"]] == ["IN-AA-RIVERBEND"]
    assert by_page[2]["category"] == "Horticulture"
    assert by_page[3]["area"]["code"] == "IN-AA-NORTH-HILL" and [a["code"] for a in by_page[3]["also_covers"]] == ["IN-AA-RIVERBEND"]
    # the heading at the foot of page 4 holds for the page's block and after it
    assert by_page[4]["area"]["code"] == "IN-AA-LAKESIDE"
    assert [a["code"] for a in by_page[4]["also_covers"]] == ["IN-AA-RIVERBEND"]
    assert by_page[5]["area"]["code"] == "IN-AA-LAKESIDE" and by_page[5]["category"] == "Livestock"
    assert [s["slug"] for s in by_page[5]["subjects"]] == ["goat", "lentil"]
    assert by_page[6]["category"] == "Livestock" and by_page[6]["subjects"] == []


def test_no_section_means_state_or_the_only_district(rows):
    first, second = rows["zones_b2.pdf"]
    assert first["area"]["level"] == "State" and len(first["also_covers"]) == 3
    assert first["category"] == "Weather" and first["weather_parameters"] == ["Rainfall"] and first["subjects"] == []
    assert second["area"]["code"] == "IN-BB-KOTA" and second["also_covers"] == []


def test_repair_applied_only_where_it_helps(got, rows):
    by = {r["document"]: r for r in got.decisions.collect()}
    assert not by["alphaland_b1.pdf"]["repair_applied"]
    b3 = by["betaland_b3.pdf"]
    assert b3["repair_applied"] == (b3["terms_after"] > b3["terms_before"])


def test_chunks_do_not_change_the_result(spark, lexicon, settings, make_pages, bulletins, got):
    from dataclasses import replace

    again = onboard.extract(make_pages(bulletins), lexicon, replace(settings, page_chunk=2))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(again.passages) == key(got.passages)


def test_facets_by_join_are_the_same(spark, lexicon, settings, make_pages, bulletins, got):
    from furrow.session import settle

    table = settle(lexicon.frame(spark), "aliases")
    again = onboard.extract(make_pages(bulletins), lexicon, settings, alias_table=table)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(again.passages) == key(got.passages)


def test_a_document_without_passages_failed_alone(lexicon, settings, make_pages, bulletins, got):
    """Readable, of a known state, but nothing long enough for a passage: failed, and no other document with it."""
    short = {"alphaland_empty.pdf": ["a line of forty characters, and no more..\n\n" + "\n\n".join(["short"] * 3)]}
    again = onboard.extract(make_pages({**bulletins, **short}), lexicon, settings)
    rows = {r["document"]: r for r in again.decisions.collect()}
    assert (rows["alphaland_empty.pdf"]["status"], rows["alphaland_empty.pdf"]["reason"]) == ("failed", "no passages extracted")
    assert {d: r["status"] for d, r in rows.items() if d not in short} == {r["document"]: r["status"] for r in got.decisions.collect()}


def test_invariants(got):
    p = got.passages
    assert p.where(F.exists("also_covers", lambda a: a["code"] == F.col("area.code"))).count() == 0
    assert p.where((F.col("category") == "Weather") & (F.size("subjects") > 0)).count() == 0
    assert p.where((F.col("category") != "Weather") & (F.size("weather_parameters") > 0)).count() == 0
    assert p.count() == p.select("point_id").distinct().count()


def test_report(got, rows):
    r = {x["document"]: x for x in got.report.collect()}["alphaland_b1.pdf"]
    assert r["pages"] == 6 and r["passages"] == len(rows["alphaland_b1.pdf"])
    assert r["districts"] == 3 and r["categories"] == {"Crop": 2, "Horticulture": 1, "Livestock": 2, "Weather": 1}
    assert r["with_subject"] == 4 and r["encoding"]["healthy"] and r["thin_warning"] and r["char_count"] > 500


@pytest.fixture(scope="module")
def resources(got, lexicon, settings):
    return onboard.catalogue(got, lexicon, settings)


def test_resources_and_passages_agree(got, resources):
    assert res.id_drift(got.passages, resources).count() == 0
    assert resources.agg(F.sum("passage_count")).head()[0] == got.passages.count()
    joined = got.passages.select("resource_id", "area.code", "language", "subjects.uri").join(
        resources.select("resource_id", "attributes"), "resource_id")
    bad = joined.where(
        ~F.exists("attributes.coverageAreas", lambda a: a["areaCode"] == F.col("code"))
        | ~F.array_contains("attributes.languages", F.col("language"))
        | (F.size(F.array_except("uri", F.coalesce(F.transform("attributes.agricultureSubjects", lambda s: s["subjectId"]), F.col("uri")))) > 0))
    assert bad.count() == 0


def test_attributes_follow_the_capability(resources):
    rows = {r["resource_id"]: json.loads(r["a"]) for r in resources.select("resource_id", F.to_json("attributes").alias("a")).collect()}
    for a in rows.values():
        weather = a["@type"].endswith("WeatherAdvisoryCapability")
        assert ("agricultureSubjects" not in a) if weather else ("weatherParameters" not in a)
        assert ("forecastHorizon" in a) == weather and a["@context"].startswith("https://")
    goat = next(a for r, a in rows.items() if "livestock" in r)
    assert goat["subjectCategories"] == ["Crop", "Livestock"]
    assert goat["evidence"]["passageCount"] == 2 and goat["evidence"]["pageRange"] == [5, 6]


def test_by_document_rollup_and_json(got, lexicon, settings):
    from furrow.sources.sinks import document_resources

    own = onboard.catalogue(got, lexicon, settings, by_document=True)
    assert all(r["s"] == [r["owner"]] for r in own.select("owner", F.col("attributes.evidence.sourceDocuments").alias("s")).collect())
    docs = {r["document"]: r for r in document_resources(own, got.report, lexicon, settings).collect()}
    b1 = docs["alphaland_b1.pdf"]
    assert b1["resourceCount"] == len(b1["resources"]) == sum(b1["capabilityTypes"].values())


def test_one_shape_whatever_the_number_of_documents(got, resources):
    a = F.col("attributes.evidence")
    assert resources.where(a["sourceDocuments"].isNotNull() | (a["documentCount"] < 1)).count() == 0
    named = res.resource_documents(got.passages).groupBy("resource_id").agg(F.count("*").alias("n"))
    assert named.join(resources, "resource_id").where(F.col("n") != a["documentCount"]).count() == 0
    assert named.count() == resources.count()


def test_second_run_is_identical(spark, lexicon, settings, make_pages, bulletins, resources):
    from furrow.operators.publishing import resource_claims

    again = onboard.catalogue(onboard.extract(make_pages(bulletins), lexicon, settings), lexicon, settings)
    assert resource_claims(again).head() == resource_claims(resources).head()


def _violations(resources, lexicon, settings, change=None, extras=None):
    df = resources if change is None else resources.withColumn("attributes", change(F.col("attributes")))
    if extras:
        df = df.withColumn("extras", F.lit(extras))
    return {r["rule"] for r in va.resource_violations(df, lexicon, settings).collect()}


def test_sound_resources_have_no_violation(resources, lexicon, settings):
    assert _violations(resources, lexicon, settings) == set()


AREA = "array<struct<codeScheme:string,areaCode:string,areaLevel:string,areaName:string>>"
SUBJ = "array<struct<subjectId:string,subjectType:string,descriptor:struct<code:string,name:string>>>"


@pytest.mark.parametrize("rule, field, value", [
    ("blank-context", "@context", "' '"),
    ("unknown-type", "@type", "'adv:Nonsense'"),
    ("no-coverage", "coverageAreas", "from_json('[]', '" + AREA + "')"),
    ("area-incomplete", "coverageAreas", "from_json('[{\"codeScheme\":\"DISTRICT\",\"areaLevel\":\"State\"}]', '" + AREA + "')"),
    ("unknown-area", "coverageAreas", "from_json('[{\"codeScheme\":\"DISTRICT\",\"areaLevel\":\"State\",\"areaCode\":\"XX\"}]', '" + AREA + "')"),
    ("unknown-scheme", "coverageAreas", "from_json('[{\"codeScheme\":\"X\",\"areaLevel\":\"State\",\"areaCode\":\"IN-AA\"}]', '" + AREA + "')"),
    ("unknown-level", "coverageAreas", "from_json('[{\"codeScheme\":\"DISTRICT\",\"areaLevel\":\"Block\",\"areaCode\":\"IN-AA\"}]', '" + AREA + "')"),
    ("no-language", "languages", "cast(array() as array<string>)"),
    ("bad-language", "languages", "array('hin')"),
    ("unknown-topic", "topics", "array('Dancing')"),
    ("unknown-weather", "weatherParameters", "array('Frogs')"),
    ("foreign-group", "weatherParameters", "array('Rainfall')"),
    ("unknown-category", "subjectCategories", "array('Fish')"),
    ("undeclared-subject-type", "subjectCategories", "array('Weather')"),
    ("bad-granularity", "geographicGranularity", "'Village'"),
    ("bad-duration", "updateFrequency", "'daily'"),
    ("unminted-subject", "agricultureSubjects", "from_json('[{\"subjectId\":\"x\",\"subjectType\":\"Crop\"}]', '" + SUBJ + "')"),
])
def test_each_rule_finds_its_fault(resources, lexicon, settings, rule, field, value):
    assert rule in _violations(resources, lexicon, settings, lambda a: a.withField(f"`{field}`", F.expr(value)))


def test_open_keys_are_searched(resources, lexicon, settings):
    found = _violations(resources, lexicon, settings, extras='{"a": [{"b": "Apply 2 kg/ha now"}], "topics": ["spray"], "coverageAreas": [{"coordinates": []}]}')
    assert found == {"prose", "coordinates"}


def test_values_are_tested_and_not_names(resources, lexicon, settings):
    sound = '{"sprayWindow": "P1D", "note": "coordinates", "place": {"coordinates": [1]}, "coverageAreas": [{"areaCode": "coordinates"}]}'
    assert _violations(resources, lexicon, settings, extras=sound) == set()
    named = resources.withColumn("attributes", F.col("attributes").withField("sprayWindow", F.lit("P1D")))
    assert va.resource_violations(named, lexicon, settings).count() == 0
    said = resources.withColumn("attributes", F.col("attributes").withField("note", F.array(F.lit("ok"), F.lit("apply 2 kg/ha"))))
    assert {r["detail"] for r in va.resource_violations(said, lexicon, settings).collect()} == {"resourceAttributes.note[1] = apply 2 kg/ha"}


def test_closed_objects_take_no_further_key(resources, lexicon, settings):
    now = F.timestamp_seconds(F.lit(1767225600))
    env = res.envelope(res.catalogs(resources, lexicon, settings, now), settings, transaction_id="t", message_id="m", now=now)
    assert va.closed_object_violations(env).count() == 0
    more = env.withColumn("context", F.col("context").withField("extraKey", F.lit("x")))
    assert [r["detail"] for r in va.closed_object_violations(more).collect()] == ["extraKey"]


def test_envelope_rules(spark, resources, lexicon, settings):
    now = F.timestamp_seconds(F.lit(1767225600))
    cats = res.catalogs(resources, lexicon, settings, now)
    env = res.envelope(cats, settings, transaction_id="t", message_id="m", now=now)
    assert va.context_violations(env).count() == 0 and va.catalog_violations(cats).count() == 0
    bad = res.envelope(cats, settings, transaction_id="", message_id="m", now=now)
    assert [r["rule"] for r in va.context_violations(bad).collect()] == ["missing-context"]
    some = spark.createDataFrame([("cat-other", "BOGUS")], "catalog_id string, catalog_type string")
    rules = [r["rule"] for r in va.directive_violations(resources, some).collect()]
    assert sorted(set(rules)) == ["bad-catalog-type", "no-directive"]
    assert va.directive_violations(resources, some.limit(0)).count() == 0
    twice = resources.unionByName(resources)
    assert va.duplicate_ids(twice).count() == resources.count()
    keys = spark.createDataFrame([("c", '{"id": 1, "offers": []}')], "catalog_id string, body string")
    assert [r["detail"] for r in va.unknown_keys(keys, "body", ["id", "provider"]).collect()] == ["offers"]
    body = json.loads(env.select(F.to_json(F.struct("context", "message")).alias("b")).head()["b"])
    assert set(body["context"]) == {"domain", "action", "version", "transactionId", "messageId", "timestamp", "schemaContext"}
    assert "availableAt" not in body["message"]["catalogs"][0]["provider"]
    assert body["message"]["catalogs"][0]["validity"] == {"startDate": "2026-01-01T00:00:00Z", "endDate": "2027-01-01T00:00:00Z"}


def test_descriptors_with_advice_are_found(resources, lexicon, settings):
    df = resources.withColumn("descriptor", F.col("descriptor").withField("longDesc", F.lit("apply urea")))
    assert {r["rule"] for r in va.resource_violations(df, lexicon, settings).collect()} == {"advice-in-descriptor"}


def test_discovery_scores(resources, settings):
    from furrow.operators.publishing import published_rows

    held = published_rows(resources, settings)
    top = dc.discover(held, area_code="IN-AA-RIVERBEND", language="en").collect()
    assert [r["score"] for r in top] == sorted((r["score"] for r in top), reverse=True) and top[0]["score"] == 4
    assert top[0]["matched_on"] == ["area", "language"]
    assert dc.discover(held, language="xx").count() == 0
    assert dc.leaks(held, ["field should be looked at"]).head()["resources"] == 0
    assert dc.facet_index(held).head()["resources"] == resources.count()


def test_area_choice_drops_the_primary(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "a", "c"]), (None, ["x"]), (None, []), ([], ["x", "y"]), (["a"], [])],
                               "s array<string>, m array<string>")
    p, r = choose_area(F.col("s"), F.col("m"), F.lit("ST"))
    assert [tuple(x) for x in df.select(p, r).collect()] == [
        ("a", ["b", "c"]), ("x", []), ("ST", []), ("ST", ["x", "y"]), ("a", [])]
