import pytest
from pyspark.sql import functions as F

from furrow.operators import gaps

PAGES = [
    "Sunflower\nSesame\nLentil\nSesame flowering has begun\nRiverbend\nAlphaland\nmaintain\nWoolly aphid in sesame needs care",
    "Spray against borer in sugarcane early\nGive water\nUrea\nVery likely\nCowpea Vegetative stage",
    "छिड़काव करें मूंगफली में मूंगफली को देखें\nSesame nursery",
    "सिंचाई अरहर हेतु",
]


@pytest.fixture(scope="module")
def found(spark, make_pages, lexicon):
    return gaps.occurrences(make_pages({"d.pdf": PAGES, "e.pdf": PAGES[:1]}), lexicon).persist()


@pytest.fixture(scope="module")
def terms(found):
    return {r["term"]: r for r in gaps.candidates(found).where("document = 'd.pdf'").collect()}


def test_signals_agree_and_double_the_score(terms):
    sesame = terms["Sesame"]
    assert sesame["signals"] == ["stage-column", "table-cell"] and sesame["hits"] == 3 and sesame["score"] == 6
    assert sesame["pages"] == 2
    assert terms["Sunflower"]["score"] == 1 and terms["Cowpea"]["signals"] == ["stage-column"]
    # "early" closes no name, so the object is not taken with it
    assert "Sugarcane early" not in terms


def test_what_is_known_or_noise_is_left_out(terms):
    for word in ("Lentil", "Riverbend", "Alphaland", "Maintain", "Urea", "Very likely"):
        assert word not in terms


def test_words_outside_latin_need_two_occurrences(terms):
    indic = [r for r in terms.values() if r["signals"] == ["indic-advisory"]]
    assert [r["hits"] for r in indic] == [2] and indic[0]["pages"] == 1


def test_evidence_and_ranking(found, terms):
    ev = {r["term"]: r["evidence"] for r in gaps.evidence(found).where("document = 'd.pdf'").collect()}
    assert set(ev) == set(terms)
    assert ev["Sesame"] == ["p.1  Sesame", "p.1  Sesame flowering has begun"]
    top = gaps.ranked(gaps.candidates(found), 2).where("document = 'd.pdf'").orderBy("rank").collect()
    assert top[0]["term"] == "Sesame" and len(top) == 2
    across = gaps.across_documents(gaps.candidates(found)).collect()
    assert (across[0]["term"], across[0]["hits"], across[0]["documents"]) == ("Sesame", 5, 2)


def test_advisory_counts(make_pages, lexicon):
    r = gaps.advisory_counts(make_pages({"d.pdf": PAGES + ["Spray the lentil"]}), lexicon).head()
    assert (r["advisory_lines"], r["unresolved_lines"]) == (4, 3)


def test_stage_search_is_linear_on_junk(spark, lexicon, make_pages):
    junk = "a" * 20000 + " sowing " + "Ab " * 5000 + "sowing"
    assert gaps.occurrences(make_pages({"d": [junk]}), lexicon).count() >= 0


def test_clean(spark):
    df = spark.createDataFrame([("  sugar   CANE -(",), ("x",)], "t string")
    assert [r[0] for r in df.select(gaps.clean(F.col("t"))).collect()] == ["Sugar cane", "X"]


def test_stages_begin_where_one_character_says_so(spark):
    import random
    import re

    from pyspark.sql import functions as F
    from furrow.operators.gaps import GapRules

    rules, rng = GapRules(stages=("tion", "ing", "was", "pre-sowing")), random.Random(2)
    ahead = re.search(r"\(\?=\[[^]]*\]\)", rules.stage_pattern).group()
    parts = ["Sta", "tion", "ing", "was", "Was", "pre-sowing", " ", "-", "/", "(", "–", ":", "x", "é", "  ", "a1", "Rice"]
    df = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))),) for _ in range(500)], "t string")
    both = [F.regexp_extract_all("t", F.lit(p), F.lit(1)) for p in (rules.stage_pattern, rules.stage_pattern.replace(ahead, ""))]
    rows = df.select(*both).collect()
    assert all(a == b for a, b in rows) and any(a for a, _ in rows)


def test_a_term_is_parted_once(spark, lexicon):
    from pyspark.sql import functions as F
    from furrow.operators.gaps import GapRules, plausible

    df = spark.createDataFrame([("Rice crop",), ("Spray rice",), ("Abcd",), ("Lentil",), ("Tomato the",), ("",)], "t string")
    test = plausible(F.col("t"), lexicon, GapRules())
    assert test._jc.toString().count("split(") == 1
    assert [bool(r[0]) for r in df.select(test).collect()] == [False, False, True, False, False, False]
