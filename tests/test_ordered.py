import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from furrow.operators.ordered import first_per, running
from furrow.operators.publishing import mark_changes


def table(spark):
    rng = random.Random(11)
    rows = [(k, p, rng.choice([None, None, p]), rng.randint(0, 3)) for k, n in (("hot", 500), ("b", 7), ("c", 1)) for p in rng.sample(range(5000), n)]
    return spark.createDataFrame(rows, "k string, p long, v long, n long")


def test_running_equals_a_plain_window_for_any_chunk(spark):
    df = table(spark).persist()
    w = Window.partitionBy("k").orderBy("p")
    for inclusive in (True, False):
        end = 0 if inclusive else -1
        want = df.select("k", "p", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, end)),
                         F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        for chunk in (1, 64, 100000):
            got = running(df, "k", "p", chunk=chunk, fill={"v": "f"}, totals={"n": "t"}, inclusive=inclusive).select("k", "p", "f", "t")
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_first_per(spark):
    df = table(spark)
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.min("p").alias("m")).collect()}
    assert {r["k"]: r["p"] for r in first_per(df, ["k"], [F.col("p")]).collect()} == want


def test_rank_limit_runs_before_the_shuffle(spark):
    plan = first_per(table(spark), ["k"], [F.col("p")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_changes_are_null_first(spark):
    df = spark.createDataFrame([("t", 1, "a"), ("t", 2, "a"), ("t", 3, "b")], "target string, seq long, claims_hash string")
    rows = mark_changes(df, "target", chunk=2).orderBy("seq").collect()
    assert [r["changed_since_previous"] for r in rows] == [None, False, True]
