import re
import uuid

from hypothesis import HealthCheck, given, settings as hsettings, strategies as st
from pyspark.sql import functions as F

from furrow.functions import prose, script, text as tx

PIECES = st.lists(st.sampled_from(
    ["a", "Bc", " ", "\t", " ", "\n", "\r", "\r\n", "•", "-", "* ", "→", " ", "\x1c", "क", "0", "x  y", "\n\n\n", "\x85"]), max_size=25)


def run(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]


def tidy_plainly(text):
    text = re.sub("\r\n?", "\n", text)
    text = re.sub("[ \t ]+", " ", text)
    text = re.sub(r"^[\s•●▪\-*→]+", "", text, flags=re.M)
    return re.sub("\n{3,}", "\n\n", "\n".join(part.strip() for part in text.split("\n"))).strip()


@hsettings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES.map("".join), min_size=40, max_size=80))
def test_tidy_matches_a_plain_restatement(spark, texts):
    assert run(spark, texts, tx.tidy("text")) == [tidy_plainly(t) for t in texts]


def test_blank_lines_and_bullets_vanish(spark):
    assert run(spark, ["a\n\nb", "• x\r\n - y  z  ", " "], tx.tidy("text")) == ["a\nb", "x\ny z", ""]


def test_ids(spark):
    df = spark.range(1)
    got = df.select(
        tx.slugify(F.lit(" Red  Lentil!")), tx.slugify(F.lit(None).cast("string")),
        tx.resource_id(F.lit("prov-x y"), F.lit("Agri"), F.lit("Crop"), F.lit("IN-AA-NORTH-HILL")),
        tx.catalog_id(F.lit("prov-x y"), F.lit("Agri"), F.lit("IN-AA")),
        tx.district_code(F.lit("IN-AA"), F.lit("North  Hill (E)")),
        tx.point_id(F.lit("prov-x"), F.lit("d.pdf"), F.lit(3), F.lit(7)), tx.subject_code(F.lit("red-lentil")),
    ).head()
    want = str(uuid.uuid5(uuid.UUID(tx.POINT_NAMESPACE), "prov-x:d.pdf:3:7"))
    assert tuple(got) == ("red-lentil", "", "res-x-y-agri-crop-in-aa-north-hill", "cat-x-y-agri-in-aa",
                          "IN-AA-NORTH-HILL-E", want, "RED_LENTIL")


def test_script_detection_thresholds(spark, settings):
    texts = ["plain words", "क" * 14, "क" * 15, "क" * 15 + "a" * 400, "ಕ" * 20, "", "123 ।॥₹", "x" * 10 + "।" * 40]
    rows = run(spark, texts, script.detect("text", settings))
    assert [r.language for r in rows] == ["en", "en", "hi", "en", "kn", "en", "en", "en"]
    assert rows[2].ambiguous and rows[2].siblings == ["hi", "mr", "ne", "sa", "kok"] and not rows[4].ambiguous
    assert rows[1].script_chars == 14 and rows[1].script == "Latin"
    assert rows[6].reason == "no letters" and rows[0].reason == "no Indic script present"
    assert "floor" in rows[1].reason and "share" in rows[3].reason


def test_languages_of_keeps_order(spark, settings):
    df = spark.createDataFrame([(["क" * 20, "abc"],)], "texts array<string>")
    assert df.select(script.languages_of(F.col("texts"), settings)).head()[0] == ["hi", "en"]


def test_encoding_health(spark):
    sound, broken = "खेत में पानी है और " * 10, "खबतपब " * 30
    rows = run(spark, [sound, broken, "latin"], script.encoding(
        script.devanagari_chars("text"), script.marker_hits("text")))
    assert [r.healthy for r in rows] == [True, False, True] and rows[2].script_chars == 0


def test_repair_undoes_swap_and_leading_vowel_sign(spark):
    # 'सिरोही' and 'बकरी' as the defective producer writes them
    broken = ["बसरोही", "िकरी"]
    assert run(spark, broken, script.repair_glyphs("text")) == ["सिरोही", "बकरी"]


def test_prose_and_formats(spark):
    texts = ["Sawai Madhopur", "Spraying of 1%", "x should  be y", "one " * 14, "one " * 15, "ml/l", "carryout"]
    assert run(spark, texts, prose.is_prose("text")) == [False, True, True, False, True, True, True]
    texts = ["P1D", "P7D", "P", "PT5H", "1D", "P1", "P1Y2M", "PT"]
    assert run(spark, texts, prose.is_duration("text")) == [True, True, False, True, False, False, True, False]
    assert run(spark, ["en", "eng", "EN"], prose.is_language_code("text")) == [True, False, False]


def test_counts(spark):
    assert run(spark, ["a b  c", "", " x "], tx.token_count("text")) == [3, 0, 1]
    assert run(spark, ["aaaa", "abab"], tx.occurrences("text", "ab")) == [0, 2]


def test_latin_text_is_english_after_one_search(spark, settings):
    texts = ["abc", "", "é ß", "क" * 20, "क" * 20 + " abc", "।॥", "ಕ" * 30, "abc" * 20 + "क"]
    assert run(spark, texts, script.language("text", settings)) == run(spark, texts, script.detect("text", settings)["language"])
    assert spark.createDataFrame([(None,)], "text string").select(script.language("text", settings)).head()[0] == "en"
    said = script.language("text", settings)._jc.toString()
    assert said.startswith("CASE WHEN")
