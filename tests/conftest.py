import json

import pytest

from furrow.operators.lexicon import CAPABILITIES, load_lexicon
from furrow.session import build_session
from furrow.settings import Settings

CROPS = {
    "_comment": "made up for the tests",
    "crops": [
        {"name": "Lentil", "slug": "lentil", "aliases": ["masoor", "मसूर"]},
        {"name": "Red lentil", "slug": "red-lentil", "aliases": ["laal dal"]},
        {"name": "Barley", "slug": "barley", "aliases": ["जौ दाना"]},
        {"name": "Tomato", "slug": "tomato", "aliases": ["टमाटर"]},
        {"name": "Onion", "slug": "onion", "aliases": ["प्याज", "बैंगनी प्याज"]},
        {"name": "Fodder 2-a", "slug": "fodder", "aliases": ["f2 (green)"]},
    ],
    "livestock": [{"name": "Goat", "slug": "goat", "aliases": ["बकरी"]}],
}
DISTRICTS = {
    "_comment": "made up",
    "IN-AA": {"state_name": "Alphaland", "primary_language": "en", "districts": [
        {"name": "North Hill", "aliases": ["northhill"]}, {"name": "Riverbend", "aliases": []},
        {"name": "Sirohi", "aliases": ["सिरोही"]}, {"name": "Lakeside", "aliases": []}]},
    "IN-BB": {"state_name": "Betaland", "primary_language": "hi", "districts": [
        {"name": "Kota", "aliases": ["कोटा"]}, {"name": "Bundi", "aliases": ["बूंदी"]},
        {"name": "Jalore", "aliases": ["जालोर"]}]},
}
CAPS = {
    "capabilities": {c.category: {"type": c.type, "subject_categories": list(c.subject_categories),
                                  "attribute_groups": list(c.attribute_groups)} for c in CAPABILITIES},
    "horticulture_slugs": ["tomato", "onion"],
    "topics": [
        {"name": "Irrigation", "aliases": ["irrigate", "सिंचाई"]}, {"name": "Spraying", "aliases": ["spray"]},
        {"name": "LivestockCare", "aliases": ["animals", "deworming"]}, {"name": "SoilMoisture", "aliases": ["नमी"]}],
    "weather_parameters": [{"name": "Rainfall", "aliases": ["rain", "rains"]}, {"name": "Humidity", "aliases": ["नमी"]}],
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(embedding_backend="lexical", embedding_dim=64)


@pytest.fixture(scope="session")
def lexicon_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("lexicon")
    for name, body in (("crops", CROPS), ("districts", DISTRICTS), ("capabilities", CAPS)):
        (root / f"{name}.json").write_text(json.dumps(body, ensure_ascii=False), encoding="utf-8")
    return str(root)


@pytest.fixture(scope="session")
def lexicon(spark, lexicon_dir, settings):
    return load_lexicon(spark, lexicon_dir, settings, {"IN-AA": ("alphaland",), "IN-BB": ("betaland", "बीटा")})


PAGE = "document string, page int, text string, ocr boolean, has_image boolean"


@pytest.fixture(scope="session")
def make_pages(spark):
    def build(documents: dict[str, list[str]], image=False):
        rows = [(d, i + 1, t, False, image) for d, texts in documents.items() for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, PAGE)

    return build
