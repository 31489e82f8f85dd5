"""The given tables seen as bulletins, with a lexicon of words they contain.

`documents` becomes pages: a source is a document, a row of it one page. The
lexicon and the rules below are to these tables what a crop lexicon and the
default rules are to real bulletins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tidy
from ..operators.gaps import GapRules
from ..operators.lexicon import Lexicon, State
from ..operators.sections import HeadingRule
from ..settings import Settings

SETTINGS = Settings(provider_id="prov-corpus", domain="Field Notes", embedding_backend="lexical", embedding_dim=64)

_SUBJECTS = (
    ("erst", "Erst", "crop", ("erst", "thor")),
    ("anon", "Anon", "crop", ("anon", "anan")),
    ("onre", "Onre", "crop", ("onre", "eriner thanea")),
    ("thin", "Thin", "crop", ("thin", "thing")),
    ("reen", "Reen", "crop", ("reen",)),
    ("license", "License", "crop", ("license", "apache", "gnu")),
    ("que", "Que", "crop", ("que", "de la")),
    ("herd", "Herd", "livestock", ("worthless", "ment", "the the")),
    ("flock", "Flock", "livestock", ("und der", "anes")),
)
_TOPICS = (
    ("Reading", ("that", "this", "dans")),
    ("Holding", ("with the", "was", "mit")),
    ("LivestockCare", ("from", "une")),
    ("Rare", ("token", "license", "apache")),
)
_WEATHER = (
    ("Mist", ("for", "pour")),
    ("Wind", ("are", "von")),
    ("Haze", ("éti", "ü")),
)
_DISTRICTS = {
    "XA": (("Elle", ("elle",)), ("Eau Vive", ("eau", "aux")), ("Tre", ("tre", "reau"))),
    "XB": (("Der", ("der", "ein")), ("Sch", ("sch",)), ("Ung", ("ung",))),
    "XC": (("Erth", ("erth", "ered")), ("Onan", ("onan",)), ("Erly", ("erly",)),
           ("Ernt", ("ernt", "of the")), ("Thatthe", ("that the",)), ("Anti", ("anti", "ering"))),
}
STATES = (
    State("XA", "Xavia", "fr", ("apache", "src1")),
    State("XB", "Xebra", "de", ("src5", "worthless")),
    State("XC", "Xocal", "en", ("the",)),
)
HORTICULTURE = ("anon", "thin", "reen", "que")


def _entries():
    rows = []
    for slug, name, kind, aliases in _SUBJECTS:
        rows += [("subject", "", a, slug, name, kind) for a in aliases]
    for name, aliases in _TOPICS:
        rows += [("topic", "", a, name, name, "") for a in aliases]
    for name, aliases in _WEATHER:
        rows += [("weather", "", a, name, name, "") for a in aliases]
    for state, districts in _DISTRICTS.items():
        for name, aliases in districts:
            code = f"{state}-{name.upper().replace(' ', '-')}"
            rows += [("district", state, a, code, name, "District") for a in aliases]
    return tuple(rows)


LEXICON = Lexicon(_entries(), STATES, horticulture=frozenset(HORTICULTURE))

HEADING = HeadingRule(
    pattern=r"(?i)(?:^|[ .,])(?:to|in|la) ([a-z /&()\-]{3,60}?) (?:of|the|der|de)(?:[ .,]|$)", groups=(1,))

GAPS = GapRules(
    stages=("tion", "ing", "was", "than", "und"),
    advisory=r"(?i)(?<![\p{L}\p{N}_])(spray|anthe|apply|onou[\p{L}\p{N}_]+|mit|que)(?![\p{L}\p{N}_])",
)
REPAIR_TERMS = ("thor", "erst", "htor", "resh", "sie", "nei")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("document"), F.col("doc_id").alias("page"), tidy("text").alias("text"),
        F.lit(False).alias("ocr"), F.lit(False).alias("has_image"),
    )
