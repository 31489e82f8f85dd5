import random
import re

import pytest
from pyspark.sql import functions as F

from furrow.operators import automaton, lexicon as lx
from furrow.settings import Settings

ALIASES = ["c++", "lentil", "red lentil", "f2 (green)", "o'hara", "2-4", "मसूर", "grün", "ü", "goat", "north hill"]


def mentions(text, alias):
    if re.match(lx.LATIN_ALIAS, alias):
        return re.search(r"(?<![a-z])" + re.escape(alias) + r"(?![a-z])", text, re.I | re.A) is not None
    return alias in text


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    parts = ["Lentil", "C++", "c++", "lentils", "red", " ", "-", "lentil", "F2 (Green)", "O'Hara", "2-4", "12-45", "मसूर", "xमसूरy", "GRÜN",
             "grün", "ü", "goat2", "_goat", "agoat", "North Hill", "north\nhill", "(", "é", "goat"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", ".", "\n"]) for _ in range(rng.randint(0, 9))) for _ in range(400)]


def test_inline_and_join_routes_equal_brute_force(spark, texts):
    want = {(i, a) for i, t in enumerate(texts) for a in ALIASES if mentions(t, a)}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    inline = df.select("i", F.explode(lx.Matcher(ALIASES).mentions("text")).alias("a"))
    assert {tuple(r) for r in inline.collect()} == want
    table = spark.createDataFrame([("subject", "", a, a, a, "crop") for a in ALIASES], lx.ENTRY_SCHEMA)
    joined = [(r["i"], r["alias"]) for r in lx.match_by_join(df, table, "i").collect()]
    assert len(joined) == len(set(joined)) and set(joined) == want


def test_machine_equals_both_other_routes(spark, texts):
    want = {(i, a) for i, t in enumerate(texts) for a in ALIASES if mentions(t, a)}
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None), (-2, "")], "i int, text string")
    table = spark.createDataFrame([("subject", "", a, a, a, "crop") for a in ALIASES + [""]], lx.ENTRY_SCHEMA)
    rows = [(r["i"], r["alias"]) for r in automaton.match(df, table, "i").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_machine_facets_equal_expressions(spark, lexicon, texts):
    """The same columns by machine, beside input columns whose names clash."""
    import dataclasses

    rows = [(t, ("IN-AA", "IN-BB", None)[i % 3], i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "text string, c0 string, t int")
    by = lambda lex: sorted(lx.with_mentions(df, lex, "text", "c0").select(
        "t", "subject_slugs", "topics", "weather_parameters", "district_codes").collect())
    assert by(dataclasses.replace(lexicon, inline_aliases=0)) == by(lexicon)


def test_machine_with_many_aliases(spark):
    """100,000 aliases by machine and by join; the time for a text does not grow with the lexicon."""
    import time

    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 7)))
    words = [word() for _ in range(100_000)]
    aliases = sorted({rng.choice([w, w + " " + word(), w + "-" + str(rng.randrange(99)), w + "\u0101"]) for w in words})
    texts = [" ".join(rng.choice([word(), rng.choice(aliases).upper() if rng.random() < .2 else rng.choice(aliases)])
                      for _ in range(60)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    table = spark.createDataFrame([("subject", "", a, a, a, "crop") for a in aliases], lx.ENTRY_SCHEMA)
    found = {(r["i"], r["alias"]) for r in automaton.match(df, table, "i").collect()}
    assert found == {(r["i"], r["alias"]) for r in lx.match_by_join(df, table, "i").collect()} and len(found) > 10_000
    machines = [automaton.Machine(rng.sample(aliases, n)) for n in (5_000, 80_000)]
    plain = [" ".join(w[::-1] + "k" for w in t.split()) for t in texts]  # hardly a mention: the walk alone is timed

    def seconds(m):
        best = 9.0
        for _ in range(3):
            started = time.perf_counter()
            for t in plain:
                m.find(t)
            best = min(best, time.perf_counter() - started)
        return best

    assert seconds(machines[1]) < 6 * seconds(machines[0])


def test_large_lexicons_are_refused_before_they_are_read(spark, lexicon_dir):
    with pytest.raises(ValueError, match="closed vocabulary"):
        lx.load_lexicon(spark, lexicon_dir, Settings(lexicon_bytes=50))
    table = spark.createDataFrame([("subject", "", "abc", "x", "x", "crop")], lx.ENTRY_SCHEMA)
    with pytest.raises(ValueError, match="match by join"):
        automaton.ship(table, 3)


def test_join_route_respects_scope(spark):
    table = spark.createDataFrame([("district", "A", "hill", "A-1", "Hill", "District"), ("district", "B", "hill", "B-1", "Hill", "District")],
                                  lx.ENTRY_SCHEMA)
    df = spark.createDataFrame([(1, "on the hill", "B")], "i int, text string, state string")
    assert [r["canonical"] for r in lx.match_by_join(df, table, "i", scope="state").collect()] == ["B-1"]


def test_per_part_agrees_with_whole(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    hits = lx.Matcher(ALIASES).mentions("text")
    rows = df.select("text", lx.per_part(F.split("text", "\n"), hits).alias("p")).collect()
    for r in rows:
        for line, found in zip(r["text"].split("\n"), r["p"]):
            assert set(found) == {a for a in ALIASES if mentions(line, a)}


def test_loading(lexicon):
    assert lexicon.canonicals("subject") == ["barley", "fodder", "goat", "lentil", "onion", "red-lentil", "tomato"]
    assert ("district", "IN-AA", "north hill", "IN-AA-NORTH-HILL", "North Hill", "District") in lexicon.entries
    assert [s.code for s in lexicon.states] == ["IN-AA", "IN-BB"] and lexicon.states[1].language == "hi"
    assert lexicon.horticulture == {"tomato", "onion"} and len(lexicon.capabilities) == 4
    assert "मसूर" in lexicon.script_terms() and "lentil" not in lexicon.script_terms()


def test_last_alias_wins(spark, tmp_path, lexicon_dir):
    import json
    import shutil

    for f in ("districts", "capabilities"):
        shutil.copy(f"{lexicon_dir}/{f}.json", tmp_path)
    crops = {"crops": [{"name": "A", "slug": "a", "aliases": ["Same "]}, {"name": "B", "slug": "b", "aliases": ["same"]}], "livestock": []}
    (tmp_path / "crops.json").write_text(json.dumps(crops))
    rows = lx.lexicon_table(spark, str(tmp_path)).where("alias = 'same'").collect()
    assert [r["canonical"] for r in rows] == ["b"]


def test_hygiene(spark, lexicon):
    frame = lexicon.frame(spark)
    hits = {(r["named"], r["canonical"]) for r in lx.alias_collisions(frame).collect()}
    assert ("red-lentil", "lentil") in hits and ("lentil", "red-lentil") not in hits
    assert [r["alias"] for r in lx.shared_aliases(frame).collect()] == ["नमी"]
    assert lx.short_aliases(frame, 4).select("alias").distinct().count() == 1


def test_plurals_do_not_match_and_digits_do_not_block(spark, lexicon):
    df = spark.createDataFrame([("lentils",), ("lentil2",), ("LENTIL",)], "text string")
    got = [r["subject_slugs"] for r in lx.with_mentions(df, lexicon).select("text", "subject_slugs").collect()]
    assert got == [[], ["lentil"], ["lentil"]]


def test_the_machine_holds_few_rows_at_once(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * automaton.TEXTS + 5))], names=["k"])
    found = list(automaton.few_at_once(iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in found] == [automaton.TEXTS, automaton.TEXTS, 5, 0]
    assert pa.Table.from_batches(found).column("k").to_pylist() == batch.column("k").to_pylist()


def test_runs_among_are_the_letter_runs_that_are_words(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(40)})
    texts = ["".join(rng.choice(["a", "b", "ab", " ", "-", "é", "1", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", lx.runs_among(F.lower("text"), words).alias("got")).collect()
    for text, got in rows:
        assert sorted(got) == sorted(set(re.split("[^a-z]+", text)) & set(words))
    # the machine that tells a place apart at its first letter is as long as its words, and no text is split
    plan = df.select(lx.Matcher(words).mentions("text"))._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan
