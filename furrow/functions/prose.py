"""Detecting advice and long sentences where only facts belong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Wording that marks advice or a dose.
ADVICE = (
    r"(?i)\b(spray(?:ing)?|apply|irrigat\w+|drench|dosage|per\s+(?:hectare|litre|liter|acre)"
    r"|ml/l|kg/ha|g/l|@\s*\d|should\s+be|advised\s+to|carry\s?out)"
)
# A text of this many tokens is a sentence, not a name.
SENTENCE_TOKENS = 15
# Keys whose values come from a closed vocabulary and are checked
# by membership instead.
CLOSED_KEYS = (
    "topics", "weatherParameters", "subjectCategories", "languages", "areaLevel",
    "codeScheme", "areaCode", "areaName", "geographicGranularity", "updateFrequency",
    "forecastHorizon", "subjectId", "subjectType", "code", "name", "passageCount",
    "pageRange",
)
# Keys of the linked-data wrapper.
STRUCTURAL_KEYS = ("@context", "@type")

# ISO 8601 duration with at least one component, and ISO 639-1 code.
# Possessive repetition: any number of parts, and nothing to recurse on.
DURATION = r"^P(?=.)(?:\d+[YMWD])*+(?:T(?:\d+[HMS])++)?$"
LANGUAGE_CODE = r"^[a-z]{2}$"


def has_advice(c: Column | str, pattern: str = ADVICE) -> Column:
    return col(c).rlike(pattern)


def is_prose(c: Column | str, pattern: str = ADVICE, tokens: int = SENTENCE_TOKENS) -> Column:
    """Advice wording, or `tokens` words or more.

    Tokens are counted, not matched by one long repetition, which Java's engine
    would recurse on.
    """
    return has_advice(c, pattern) | (F.regexp_count(col(c), F.lit(r"\S+")) >= tokens)


def is_duration(c: Column | str) -> Column:
    return col(c).rlike(DURATION)


def is_language_code(c: Column | str) -> Column:
    return col(c).rlike(LANGUAGE_CODE)
