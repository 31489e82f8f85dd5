"""Which terms does a corpus use that the lexicon does not know?

Four line-level signals produce (document, page, term, signal) rows, implausible
terms are dropped, and the rest is counted and ranked. Every step is a native
expression over lines of one page; terms are combined map-side before shuffles.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, string_array, strip
from . import gap_words as words
from .lexicon import Lexicon, Matcher, districts_of, is_latin


INDIC = "indic-advisory"


@dataclass(frozen=True)
class GapRules:
    """Patterns and word lists of the scan; all of them can be replaced."""

    stages: tuple[str, ...] = words.STAGES
    cell: str = words.CELL
    object_of: str = words.OBJECT
    advisory: str = words.ADVISORY
    head: str = words.HEAD
    title: str = words.TITLE
    chemical: str = words.CHEMICAL
    indic_word: str = words.INDIC_WORD
    indic_trim: str = words.INDIC_TRIM
    indic_endings: tuple[str, ...] = words.INDIC_ENDINGS
    stop: tuple[str, ...] = words.STOP
    leading_verbs: tuple[str, ...] = words.LEADING_VERBS
    not_a_subject: tuple[str, ...] = words.NOT_A_SUBJECT
    function_words: tuple[str, ...] = words.FUNCTION_WORDS
    indic_stop: tuple[str, ...] = words.INDIC_STOP
    evidence_lines: int = 2
    evidence_chars: int = 110
    indic_least: int = 2

    @property
    def stage_pattern(self) -> str:
        # One to three names before a stage. A match can only begin where a run of
        # letters does, and runs are told apart by their separators, so the
        # search is linear in the line.
        names = "|".join(s.replace("-", "\\-") for s in self.stages)
        term = r"(?<![A-Z])([A-Z][a-z]+(?:[ /-]{1,2}[A-Z][a-z]+){0,2}[ /-]{0,2})"
        # What cannot begin a stage or what stands before one is told by one character.
        first = r"(?=[\s(\-–—:" + "".join(sorted({re.escape(s[0]) for s in self.stages if s})) + "])" if all(self.stages) else ""
        return r"(?i)" + term + first + r"\s*[\(\-–—:]?\s*(?:" + names + r")(?![\p{L}\p{N}_])"

    @property
    def stage_words(self) -> tuple[str, ...]:
        return tuple(sorted({w for s in self.stages for w in s.replace("-", " ").split()}))


def clean(term: Column) -> Column:
    """White space folded, edge punctuation off, first letter upper, rest lower."""
    trimmed = strip(F.btrim(F.regexp_replace(term, r"\s+", " "), F.lit(" -/:()")))
    return let(trimmed, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 2147483647))))


def _in(word: Column, listed) -> Column:
    return word.isin(*listed) if listed else F.lit(False)


def plausible(term: Column, lexicon: Lexicon, rules: GapRules, state: Column | None = None) -> Column:
    """False for what is certainly no missing subject."""
    subjects = Matcher(lexicon.aliases("subject")).mentions(term)
    places = Matcher(lexicon.aliases("district")).mentions(term)
    placed = F.size(places) > 0
    if state is not None:
        placed = F.when(state.isNotNull(), F.size(districts_of(places, state, lexicon)) > 0).otherwise(placed)
    names = [s.name.lower() for s in lexicon.states]

    def listed(low, parts):
        first, last = F.get(parts, F.lit(0)), F.try_element_at(parts, F.lit(-1))
        return (
            ~_in(first, rules.leading_verbs) & ~_in(first, rules.stop)
            & ~((F.size(parts) > 1) & _in(last, rules.stop))
            & ~F.arrays_overlap(parts, string_array(rules.function_words))
            & ~F.arrays_overlap(parts, string_array(rules.stage_words))
            & ~_in(low, rules.not_a_subject) & ~_in(low, names)
        )

    # The cheap tests come first; the term is lower-cased and parted once for all that look at its parts.
    return (
        F.length(term).between(4, 32)
        & let(F.lower(term), lambda low: ~_in(low, rules.stop) & let(
            F.split(strip(low), r"\s+"), lambda parts: listed(low, parts)))
        & term.rlike(rules.title)
        & ~term.rlike(rules.chemical)
        & (F.size(subjects) == 0)
        & ~placed
    )


def lines(pages: DataFrame) -> DataFrame:
    """Non-blank lines with their place."""
    return (
        pages.select("document", "page", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .withColumn("stripped", strip("line")).where(F.length("stripped") > 0)
    )


def _tagged(signal: str, terms: Column) -> Column:
    return F.transform(terms, lambda t: F.struct(F.lit(signal).alias("signal"), t.alias("term")))


def signals(line_rows: DataFrame, lexicon: Lexicon, rules: GapRules) -> DataFrame:
    """Raw terms per line, by signal, before any plausibility check."""
    line, stripped = F.col("line"), F.col("stripped")
    none = F.array().cast("array<string>")
    line_rows = line_rows.withColumn("advisory", line.rlike(rules.advisory))
    advisory = F.col("advisory")
    names = "|".join(s.replace("-", "\\-") for s in rules.stages)
    staged = F.when(line.rlike(f"(?i)(?:{names})"), F.regexp_extract_all(line, F.lit(rules.stage_pattern), F.lit(1))).otherwise(none)
    cell = F.when(F.length(stripped).between(4, 30) & stripped.rlike(rules.cell), F.array(stripped)).otherwise(none)
    objects = F.when(advisory, F.regexp_extract_all(line, F.lit(rules.object_of), F.lit(1))).otherwise(none)
    flagged = line_rows.withColumn(
        "unresolved", advisory & (F.size(Matcher(lexicon.aliases("subject")).mentions(line)) == 0))
    head = F.regexp_extract(stripped, rules.head, 1)
    heads = F.when(F.col("unresolved") & (head != ""), F.array(head)).otherwise(none)
    return flagged.withColumn("terms", F.concat(
        _tagged("stage-column", staged), _tagged("table-cell", cell),
        _tagged("advisory-object", objects), _tagged("advisory-no-subject", heads),
        _tagged(INDIC, F.when(F.col("unresolved"), indic_terms(line, lexicon, rules)).otherwise(none))))


def indic_terms(line: Column, lexicon: Lexicon, rules: GapRules) -> Column:
    """Words outside Latin of a line that hold no known alias and no verb ending."""
    known = string_array(sorted(a for a in lexicon.aliases() if not is_latin(a)))
    trimmed = F.transform(
        F.regexp_extract_all(line, F.lit(f"({rules.indic_word})"), F.lit(1)),
        lambda w: F.btrim(w, F.lit(rules.indic_trim)))

    def kept(w):
        ends = F.lit(False)
        for e in rules.indic_endings:
            ends = ends | F.endswith(w, F.lit(e))
        return (
            (F.length(w) >= 3) & ~_in(w, rules.indic_stop) & ~ends
            & ~F.exists(known, lambda k: F.contains(w, k))
        )

    return F.when(F.octet_length(line) > F.length(line), F.filter(trimmed, kept)).otherwise(
        F.array().cast("array<string>"))


def occurrences(pages: DataFrame, lexicon: Lexicon, rules: GapRules = GapRules(),
                state: str | None = None) -> DataFrame:
    """(document, page, line_no, stripped, seq, term, signal) rows in one pass.

    Terms outside Latin that stand only once in a document are still among them;
    `candidates` and `evidence` leave them out.
    """
    flagged = signals(lines(pages), lexicon, rules)
    scope = F.col(state) if state else None
    cleaned = F.transform("terms", lambda t, i: F.struct(
        i.alias("seq"), t["signal"].alias("signal"),
        F.when(t["signal"] == INDIC, t["term"]).otherwise(clean(t["term"])).alias("term")))
    # Inside a lambda a cleaned term is a value; as a column it would be spelled out in, and worked out for, every
    # test. The outer form keeps Spark from adding a filter that works out all terms a second time.
    kept = F.filter(cleaned, lambda t: (t["signal"] == INDIC) | plausible(t["term"], lexicon, rules, scope))
    return (
        flagged.select("document", "page", "line_no", "stripped", F.explode_outer(kept).alias("t"))
        .where(F.col("t.term").isNotNull())
        .select("document", "page", "line_no", "stripped", "t.seq", "t.term", "t.signal")
    )


def candidates(found: DataFrame, rules: GapRules = GapRules()) -> DataFrame:
    """Per document and term: hits, signals, pages, and score. A term with two
    signals counts double.

    Rows are first combined to (document, term, signal, page), so a term that
    fills a document arrives as one row per page and signal.
    """
    per_page = found.groupBy("document", "term", "signal", "page").agg(F.count("*").alias("n"))
    return (
        per_page.groupBy("document", "term", "page").agg(
            F.sum("n").alias("n"), F.collect_set("signal").alias("s"))
        .groupBy("document", "term").agg(
            F.sum("n").alias("hits"),
            # a term outside Latin is placed on the first of its pages only
            F.greatest(F.count_if(F.array_max("s") != INDIC), F.lit(1)).alias("pages"),
            # at most five signals exist, so at most 31 distinct lists
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("signals"))
        .where((F.array_max("signals") != INDIC) | (F.col("hits") >= rules.indic_least))
        .withColumn("score", F.col("hits") * F.when(F.size("signals") > 1, 2).otherwise(1))
    )


def evidence(found: DataFrame, rules: GapRules = GapRules()) -> DataFrame:
    """The first lines each term stands on, two by default; one outside Latin."""
    # One line more than shown tells a single occurrence from several.
    most = max(rules.evidence_lines, rules.indic_least)
    rank = F.row_number().over(Window.partitionBy("document", "term").orderBy("page", "line_no", "seq"))
    text = F.format_string("p.%d  %s", F.col("page"), F.col("stripped"))
    # Lines are cut to what is shown before they move.
    short = found.withColumn("stripped", F.substring("stripped", 1, rules.evidence_chars))
    kept = short.withColumn("_n", rank).where(F.col("_n") <= most)
    gathered = kept.withColumn("line", text).groupBy("document", "term").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_n", "line"))), lambda x: x["line"]).alias("_lines"),
        F.max("signal").alias("_signal"))
    indic = F.col("_signal") == INDIC
    return gathered.where(~indic | (F.size("_lines") >= rules.indic_least)).select(
        "document", "term",
        F.slice("_lines", 1, F.when(indic, 1).otherwise(rules.evidence_lines)).alias("evidence"))


def ranked(cands: DataFrame, limit: int = 30) -> DataFrame:
    """Highest score first, ties by term, `limit` per document."""
    rank = F.row_number().over(Window.partitionBy("document").orderBy(F.desc("score"), "term"))
    return cands.withColumn("rank", rank).where(F.col("rank") <= limit)


def across_documents(cands: DataFrame, limit: int = 15) -> DataFrame:
    """Terms over all documents: total hits and in how many documents."""
    return (
        cands.groupBy("term").agg(F.sum("hits").alias("hits"), F.count("*").alias("documents"))
        .orderBy(F.desc("hits"), "term").limit(limit)
    )


def advisory_counts(pages: DataFrame, lexicon: Lexicon, rules: GapRules = GapRules()) -> DataFrame:
    """Advisory lines per document, and those naming no known subject."""
    flagged = signals(lines(pages), lexicon, rules)
    return flagged.groupBy("document").agg(
        F.count_if("advisory").alias("advisory_lines"), F.count_if("unresolved").alias("unresolved_lines"))
