import random
import re
import time

from pyspark.sql import functions as F

from furrow.operators.segment import page_passages, with_blocks

A = "Lentil leaves turn yellow early so inspect the field every morning without fail."
B = "Tomato fruit cracks after heavy rain so pick the ripe fruit regularly and quickly."
PLAIN = "Keep the channel clean and remove standing water from the lower end of the field."
SLUGS = ("lentil", "tomato", "onion")


def crops(text):
    return [[s for s in SLUGS if s in line.lower()] for line in text.split("\n")]


def cut_all(spark, texts, least=80, most=700):
    df = spark.createDataFrame([(i, t, crops(t)) for i, t in enumerate(texts)], "i int, text string, c array<array<string>>")
    rows = df.select("i", page_passages(F.col("text"), F.col("c"), least, most).alias("b")).collect()
    return [r["b"] for r in sorted(rows, key=lambda r: r["i"])]


# -- the rules once more, over one list of (text, crops) that is rewritten until nothing changes -------------------

def apart(a, b):
    return bool(a and b and not a & b)


def expected(text, least, most):
    parts = []
    for block in re.split(r"\n\s*\n", text):
        lines = [x for x in block.strip().split("\n") if x.strip()]
        own = []
        for line in lines:
            named = set(crops(line)[0])
            if own and not (apart(own[-1][1], named) and len(own[-1][0]) >= least):
                own[-1] = (own[-1][0] + "\n" + line, own[-1][1] | named)
            else:
                own.append((line, named))
        at = 1
        while at < len(own):
            if min(len(own[at - 1][0]), len(own[at][0])) < least:
                own[at - 1: at + 1] = [(own[at - 1][0] + "\n" + own[at][0], own[at - 1][1] | own[at][1])]
            else:
                at += 1
        parts += own
    made = []
    for body, named in parts:
        whole = len(body) <= most
        if whole and made and made[-1][0] and len(made[-1][0]) + len(body) + 2 <= most and not (
                apart(made[-1][1], named) and len(made[-1][0]) >= least):
            made[-1] = (made[-1][0] + "\n\n" + body, made[-1][1] | named)
            continue
        while len(body) > most:
            found = [m.start() for m in re.finditer("\n", body[:most]) if m.start()]
            place = found[-1] if found else most
            made.append((body[:place].strip(), named))
            body = body[place:].strip()
        made.append((body, named))
    return [t for t, _ in made if len(t) >= least]


def test_rules(spark):
    cases = {
        f"{A}\n{B}": [A, B],                                        # two crops
        f"{A}\n{PLAIN}\n{B}": [f"{A}\n{PLAIN}", B],                  # a line naming no crop continues its run
        f"{A}\nOnion lodging.": [f"{A}\nOnion lodging."],           # a short tail goes back
        f"Onion now.\n{A}": [f"Onion now.\n{A}"],                   # a short head waits
        f"{A}\n\n{PLAIN}": [f"{A}\n\n{PLAIN}"],                     # blocks merge up to the cap
        "too short": [], "": [], "\n \n": [],
    }
    assert cut_all(spark, list(cases)) == list(cases.values())
    assert [len(p) for p in cut_all(spark, ["x" * 1500])[0]] == [700, 700, 100]
    long = cut_all(spark, ["\n\n".join([PLAIN] * 12)])[0]
    assert len(long) == 2 and all(len(p) <= 700 for p in long)


def test_against_the_rules_on_lists(spark):
    rng = random.Random(3)
    lines = [A, B, PLAIN, "Onion.", "", "  ", "\t x", " Lentil tomato ", "é" * 30, "\x0b", "a b  ", "\r"]
    texts = ["\n".join(rng.choice([*lines, "x" * rng.randint(1, 900)]) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    for least, most in ((80, 700), (5, 40), (1, 10)):
        assert cut_all(spark, texts, least, most) == [expected(t, least, most) for t in texts]


def test_splitting_loses_no_character_but_line_ends(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice([A, B, PLAIN, "Onion.", "x" * rng.randint(1, 90)]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    flat = lambda s: "".join(s.split())
    for text, made in zip(texts, cut_all(spark, texts)):
        got = flat("".join(made))
        # only a final rest of fewer than 80 characters may go
        assert flat(text).startswith(got) or got in flat(text)
        assert len(flat(text)) - len(got) < 80 * (1 + len(text) // 700)


def test_on_pages_without_a_python_worker(spark, lexicon, settings, make_pages):
    pages = make_pages({"d": [f"{A}\n{B}", PLAIN, "", None]})
    made = with_blocks(pages, lexicon, settings).orderBy("page").select("blocks")
    assert [r["blocks"] for r in made.collect()] == [[A, B], [PLAIN], [], []]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_time_of_slicing_is_in_proportion_to_the_text(spark):
    text = "\n".join([f"{'x' * 300} {i}  " for i in range(3000)] + ["y" * 400_000])
    started = time.perf_counter()
    made = cut_all(spark, [text])[0]
    assert time.perf_counter() - started < 30
    assert made == expected(text, 80, 700)
