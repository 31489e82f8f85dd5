"""The closed lexicon: loading it, matching text against it, and its hygiene.

A lexicon is a table of aliases. Matching turns the "text mentions alias"
comparison into set membership wherever that is exact:

* an alias of letters only is mentioned iff it is one of the text's letter runs;
* other Latin aliases need their literal text present and no letter beside it;
* aliases in other scripts need only be contained.

Small lexicons are inlined as literals, so a text is matched in one narrow pass
without shuffle or join. Lexicons over `Settings.inline_alias_limit` aliases are
matched by a machine of all aliases (`automaton`), those too large to ship by
`match_by_join`, an equi-join on one anchor per alias.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import alias_key, col, district_code, let, literal, string_array
from ..settings import Settings

# An alias made of these characters is Latin and is matched
# without regard to case and with no letter on either side.
LATIN_ALIAS = r"^[a-z0-9 ()\-']+$"

# What sets an alias without a letter run apart; every such alias has one.
TELLING = "[^a-z ]"

ENTRY_SCHEMA = T.StructType([
    T.StructField("dimension", T.StringType()),   # subject district topic weather
    T.StructField("scope", T.StringType()),       # state code for districts, else ''
    T.StructField("alias", T.StringType()),
    T.StructField("canonical", T.StringType()),   # slug, area code, topic, parameter
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),        # crop livestock District ''
])


@dataclass(frozen=True)
class Capability:
    category: str
    type: str
    subject_categories: tuple[str, ...]
    attribute_groups: tuple[str, ...]


# The capability each category publishes, the subject categories
# it declares and the attribute groups it may carry.
CAPABILITIES = (
    Capability("Crop", "CropAdvisoryCapability", ("Crop",), ("agricultureSubjects", "topics")),
    Capability("Weather", "WeatherAdvisoryCapability", ("Weather",), ("weatherParameters", "topics")),
    Capability("Livestock", "LivestockAdvisoryCapability", ("Livestock",), ("agricultureSubjects", "topics")),
    Capability("Horticulture", "HorticultureAdvisoryCapability", ("Crop", "Horticulture"),
               ("agricultureSubjects", "topics")),
)
# The topic that marks livestock advice naming no animal.
LIVESTOCK_TOPIC = "LivestockCare"


@dataclass(frozen=True)
class State:
    code: str
    name: str
    language: str = "en"
    markers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lexicon:
    """A checked, inlinable lexicon. States are listed in detection priority."""

    entries: tuple[tuple[str, str, str, str, str, str], ...]
    states: tuple[State, ...]
    capabilities: tuple[Capability, ...] = CAPABILITIES
    horticulture: frozenset[str] = frozenset()
    livestock_topic: str = LIVESTOCK_TOPIC
    inline_aliases: int = 2000  # more than these are matched by machine
    _index: dict = field(default_factory=dict, compare=False, repr=False)

    # -- views ---------------------------------------------------------------
    def rows(self, dimension: str, scope: str | None = None):
        return [e for e in self.entries
                if e[0] == dimension and (scope is None or e[1] == scope)]

    def canonicals(self, dimension: str) -> list[str]:
        return sorted({e[3] for e in self.rows(dimension)})

    def aliases(self, dimension: str | None = None) -> list[str]:
        return sorted({e[2] for e in self.entries if dimension in (None, e[0])})

    def frame(self, spark: SparkSession) -> DataFrame:
        df = spark.createDataFrame(list(self.entries), ENTRY_SCHEMA)
        return df.withColumn("is_latin", F.col("alias").rlike(LATIN_ALIAS))

    def script_terms(self, lo: int = 0x0900, hi: int = 0x097F) -> list[str]:
        """Subject and district aliases with a character of one script block."""
        return sorted({
            e[2] for e in self.entries
            if e[0] in ("subject", "district") and any(lo <= ord(c) <= hi for c in e[2])
        })

    def subject_struct(self, slug: Column, settings: Settings) -> Column:
        """Name, kind and URI of a subject slug, from inlined literals."""
        names = self._literal_map("subject", lambda e: (e[3], e[4]))
        kinds = self._literal_map("subject", lambda e: (e[3], e[5]))
        kind = F.element_at(kinds, slug)
        return F.struct(
            slug.alias("slug"),
            F.element_at(names, slug).alias("name"),
            kind.alias("kind"),
            F.concat(F.lit(settings.taxonomy_base + "/"), kind, F.lit("/"), slug).alias("uri"),
        )

    def state_of_area(self, code: Column) -> Column:
        """The state of a district code; a state code is its own."""
        owners = {e[3]: e[1] for e in self.rows("district")}
        return F.coalesce(F.element_at(_map(owners), code), code) if owners else code

    def area_struct(self, code: Column, settings: Settings) -> Column:
        """Name, level and scheme of a state or district code."""
        names = {s.code: s.name for s in self.states}
        names.update({e[3]: e[4] for e in self.rows("district")})
        levels = {s.code: "State" for s in self.states}
        level = F.coalesce(F.element_at(_map(levels), code), F.lit("District"))
        return F.struct(
            code.alias("code"),
            F.element_at(_map(names), code).alias("name"),
            level.alias("level"),
            F.when(level == "State", settings.state_scheme)
            .otherwise(settings.district_scheme).alias("scheme"),
        )

    def _literal_map(self, dimension, pick) -> Column:
        return _map(dict(pick(e) for e in self.rows(dimension)))


def _map(values: dict[str, str]) -> Column:
    if not values:
        return F.create_map().cast("map<string,string>")
    return literal(values, "map<string,string>")


def is_latin(alias: str) -> bool:
    return re.match(LATIN_ALIAS, alias) is not None


# -- loading -------------------------------------------------------------------

_TERMS = "array<struct<name:string,slug:string,aliases:array<string>>>"


def _document(spark: SparkSession, path: str) -> DataFrame:
    """A whole JSON file as one row; a missing path raises."""
    return spark.read.text(path, wholetext=True)


def _alias_rows(df: DataFrame) -> DataFrame:
    """One row per alias; the name itself is one, and the last listing wins."""
    out = (
        df.withColumn("_all", F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))
        .select("*", F.posexplode("_all").alias("_pos", "_alias"))
        .withColumn("alias", alias_key("_alias"))
    )
    keep = F.struct("canonical", "name", "kind")
    return (
        out.groupBy("dimension", "scope", "alias")
        .agg(F.max_by(keep, F.struct("_row", "_pos")).alias("v"))
        .select("dimension", "scope", "alias", "v.canonical", "v.name", "v.kind")
    )


def lexicon_table(spark: SparkSession, directory: str) -> DataFrame:
    """The alias table of a directory holding `crops.json`, `districts.json` and
    `capabilities.json`. Keys of the district file that begin with `_` are notes."""
    crops = _document(spark, f"{directory}/crops.json").select(
        F.from_json("value", f"crops {_TERMS}, livestock {_TERMS}").alias("j"))
    caps = _document(spark, f"{directory}/capabilities.json").select(
        F.from_json("value", f"topics {_TERMS}, weather_parameters {_TERMS}").alias("j"))
    districts = _district_blocks(spark, directory)

    def terms(df, path, dimension, kind, canonical, offset):
        return (
            df.select(F.posexplode(f"j.{path}").alias("_i", "r"))
            .select(
                F.lit(dimension).alias("dimension"), F.lit("").alias("scope"),
                F.col(f"r.{canonical}").alias("canonical"), "r.name",
                F.lit(kind).alias("kind"), "r.aliases",
                (F.col("_i") + offset).alias("_row"),
            )
        )

    district_rows = districts.select("state", F.posexplode("b.districts").alias("_row", "r")).select(
        F.lit("district").alias("dimension"), F.col("state").alias("scope"),
        district_code("state", "r.name").alias("canonical"), "r.name",
        F.lit("District").alias("kind"), "r.aliases", "_row",
    )
    everything = (
        terms(crops, "crops", "subject", "crop", "slug", 0)
        .unionByName(terms(crops, "livestock", "subject", "livestock", "slug", 1_000_000))
        .unionByName(terms(caps, "topics", "topic", "", "name", 0))
        .unionByName(terms(caps, "weather_parameters", "weather", "", "name", 0))
        .unionByName(district_rows)
    )
    return _alias_rows(everything)


def _district_blocks(spark: SparkSession, directory: str) -> DataFrame:
    raw = _document(spark, f"{directory}/districts.json").select(
        F.explode(F.from_json("value", "map<string,string>")).alias("state", "block"))
    shape = f"state_name string, primary_language string, districts {_TERMS}"
    return raw.where(~F.col("state").startswith("_")).select(
        "state", F.from_json("block", shape).alias("b"))


def load_lexicon(spark: SparkSession, directory: str, settings: Settings,
                 markers: dict[str, tuple[str, ...]] | None = None) -> Lexicon:
    """Read a lexicon directory. A lexicon is a closed vocabulary kept by hand; its
    size is measured first, and one beyond `Settings.lexicon_bytes` is refused: it
    stays a table, for `automaton.match`. Up to `Settings.inline_alias_limit` aliases
    become expressions, more become a machine.

    `markers` gives, in priority order, the wording that assigns a document to a
    state; without it a state is recognised by its own name.
    """
    table = lexicon_table(spark, directory)
    size = table.agg(F.coalesce(F.sum(sum(F.octet_length(c) for c in ("alias", "canonical", "name"))), F.lit(0))).first()[0]
    if size > settings.lexicon_bytes:
        raise ValueError(f"a lexicon of {size} bytes is no closed vocabulary (at most {settings.lexicon_bytes}): match it as a table")
    rows = table.collect()
    states = {
        r["state"]: State(r["state"], r["state_name"], r["primary_language"] or "en",
                          (r["state_name"].lower(),))
        for r in _district_blocks(spark, directory)
        .select("state", "b.state_name", "b.primary_language").orderBy("state").collect()
    }
    if markers:
        ordered = [code for code in markers if code in states]
        ordered += [code for code in states if code not in markers]
        states = {
            code: State(code, states[code].name, states[code].language,
                        tuple(markers.get(code, states[code].markers)))
            for code in ordered
        }
    caps = _document(spark, f"{directory}/capabilities.json").select(F.from_json(
        "value",
        "capabilities map<string,struct<type:string,subject_categories:array<string>,"
        "attribute_groups:array<string>>>, horticulture_slugs array<string>",
    ).alias("j")).select("j.*").head()
    capabilities = tuple(
        Capability(k, v["type"], tuple(v["subject_categories"]), tuple(v["attribute_groups"]))
        for k, v in caps["capabilities"].items()
    )
    entries = tuple(sorted(tuple(r[f.name] for f in ENTRY_SCHEMA) for r in rows))
    return Lexicon(entries, tuple(states.values()), capabilities,
                   frozenset(caps["horticulture_slugs"] or ()), inline_aliases=settings.inline_alias_limit)


# -- matching -------------------------------------------------------------------

def letter_runs(text: Column | str) -> Column:
    """Distinct maximal runs of ASCII letters, lower case."""
    return F.array_distinct(F.split(F.lower(col(text)), "[^a-z]+"))


_META = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def bounded_pattern(alias: str) -> str:
    """The alias with no ASCII letter on either side."""
    return f"(?<![a-z]){_META.sub(r'\\\1', alias)}(?![a-z])"


def _branches(words: list[str]) -> str:
    """A pattern of exactly these words, letter by letter, the longest first: a place is left at the first letter that
    no word goes on with, however many words there are."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    inner = "|".join(head + _branches(rest) for head, rest in sorted(heads.items()))
    if not heads:
        return ""
    if "" in words:
        return f"(?:{inner})?"
    return f"(?:{inner})" if len(heads) > 1 else inner


def runs_among(low: Column, words: list[str]) -> Column:
    """Which of `words`, all of letters, are letter runs of a lower-cased text, each once. Only these are made strings."""
    pattern = f"(?<![a-z]){_branches(sorted(set(words)))}(?![a-z])"
    return F.array_distinct(F.regexp_extract_all(low, F.lit(pattern), F.lit(0)))


class Matcher:
    """Mentions of a set of aliases, as one array-valued column expression."""

    def __init__(self, aliases):
        aliases = sorted(set(aliases))
        self.runs = [a for a in aliases if re.fullmatch("[a-z]+", a)]
        self.phrases = [a for a in aliases if is_latin(a) and a not in set(self.runs)]
        self.others = [a for a in aliases if not is_latin(a)]

    def mentions(self, text: Column | str) -> Column:
        """Aliases the text mentions; order is not specified."""
        text = col(text)
        parts = []
        if self.runs:
            parts.append(runs_among(F.lower(text), self.runs))
        if self.phrases:
            table = literal([{"a": a, "p": bounded_pattern(a)} for a in self.phrases],
                            "array<struct<a:string,p:string>>")
            hits = let(F.lower(text), lambda low: F.filter(
                table, lambda x: F.contains(low, x["a"]) & F.regexp_like(low, x["p"])))
            parts.append(F.transform(hits, lambda x: x["a"]))
        if self.others:
            held = F.filter(string_array(self.others), lambda a: F.contains(text, a))
            if any(a.isascii() for a in self.others):
                parts.append(held)
            else:  # only text beyond ASCII can hold one of these
                beyond = F.octet_length(text) > F.length(text)
                parts.append(F.when(beyond, held).otherwise(F.array().cast("array<string>")))
        if not parts:
            return F.array().cast("array<string>")
        found = parts[0] if len(parts) == 1 else F.concat(*parts)
        return F.coalesce(found, F.array().cast("array<string>"))


def per_part(parts: Column, candidates: Column, words: list[str] | None = None) -> Column:
    """For each text of an array, which of the candidate aliases it mentions.

    `candidates` are the aliases of the whole text, so parts are only tested
    against the handful that can occur. `words`, if known, are all that can be candidates and are of letters only.
    """
    def mentioned(a, part, low, runs):
        pattern = F.concat(
            F.lit("(?<![a-z])"), F.regexp_replace(a, r"([()\-])", r"\\$1"), F.lit("(?![a-z])"))
        return (
            F.when(a.rlike("^[a-z]+$"), F.array_contains(runs, a))
            .when(a.rlike(LATIN_ALIAS), F.contains(low, a) & F.regexp_like(low, pattern))
            .otherwise(F.contains(part, a))
        )

    def one(part, among):
        found = lambda low: F.split(low, "[^a-z]+") if words is None else runs_among(low, words)
        return let(F.lower(part), lambda low: let(found(low), lambda runs: F.filter(
            among, lambda a: mentioned(a, part, low, runs))))

    return let(candidates, lambda among: F.transform(parts, lambda part: one(part, among)))


def to_canonical(aliases: Column, rows) -> Column:
    """Sorted distinct canonicals of those aliases that are in `rows`."""
    table = {}
    for e in rows:
        table[e[2]] = e[3]
    if not table:
        return F.array().cast("array<string>")
    lookup = _map(table)
    mapped = F.transform(aliases, lambda a: F.element_at(lookup, a))
    return F.array_sort(F.array_distinct(F.filter(mapped, lambda x: x.isNotNull())))


def with_mentions(df: DataFrame, lexicon: Lexicon, text: str = "text", state: str | None = None,
                  by_join: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Add `subject_slugs`, `topics`, `weather_parameters` and, when `state` names
    a column of state codes, `district_codes` of that state.

    `by_join` is a unique key column of `df` and the alias table: then aliases are
    found by equi-join, which is for lexicons too large to ship. Without it a lexicon
    beyond its `inline_aliases` is matched by machine. Results are the same."""
    if by_join:
        return _joined_mentions(df, *by_join, text, state)
    if len(lexicon.entries) > lexicon.inline_aliases:
        from .automaton import Shipped, with_facets

        return with_facets(df, Shipped(df.sparkSession, [e[:4] for e in lexicon.entries]), text, state)
    out = df.withColumn("_hits", Matcher(lexicon.aliases()).mentions(text))
    cols = {
        "subject_slugs": to_canonical(F.col("_hits"), lexicon.rows("subject")),
        "topics": to_canonical(F.col("_hits"), lexicon.rows("topic")),
        "weather_parameters": to_canonical(F.col("_hits"), lexicon.rows("weather")),
    }
    if state:
        cols["district_codes"] = districts_of(F.col("_hits"), F.col(state), lexicon)
    return out.withColumns(cols).drop("_hits")


def _joined_mentions(df: DataFrame, key: str, table: DataFrame, text: str, state: str | None) -> DataFrame:
    hits = match_by_join(df.select(key, text), table, key, text)
    if state:
        hits = hits.join(df.select(F.col(key).alias("_at"), F.col(state).alias("_state")), F.col(key) == F.col("_at"))
    named = {"subject_slugs": "subject", "topics": "topic", "weather_parameters": "weather"}
    tests = {c: F.col("dimension") == d for c, d in named.items()}
    if state:
        tests["district_codes"] = (F.col("dimension") == "district") & (F.col("scope") == F.col("_state"))
    found = hits.groupBy(F.col(key).alias("_key")).agg(
        *[F.array_sort(F.collect_set(F.when(t, F.col("canonical")))).alias(c) for c, t in tests.items()])
    empty = F.array().cast("array<string>")
    return df.join(found, F.col(key) == F.col("_key"), "left").withColumns(
        {c: F.coalesce(c, empty) for c in tests}).drop("_key")


def districts_of(aliases: Column, state: Column, lexicon: Lexicon) -> Column:
    """Districts of the given state among the mentioned aliases."""
    empty = F.array().cast("array<string>")
    out = empty
    for s in lexicon.states:
        out = F.when(state == s.code, to_canonical(aliases, lexicon.rows("district", s.code))).otherwise(out)
    return out


# -- the route for lexicons too large to inline ----------------------------------

def match_by_join(texts: DataFrame, lexicon: DataFrame, key: str, text: str = "text",
                  scope: str | None = None) -> DataFrame:
    """Distinct (key, dimension, scope, alias, canonical) mentions by equi-join.

    Every alias has an anchor: a Latin one its longest letter run, any other the
    first of its characters that is neither a small letter nor a blank, with the
    character after it. A text offers its distinct letter runs and its distinct
    characters of that kind, alone and with their successor. Equal anchors make
    a candidate, which the exact test confirms. Give the lexicon as a stored table:
    Spark then knows its size, broadcasts one under the threshold, so that offers
    are never shuffled, and shuffles both sides otherwise. No text meets an alias it does
    not share an anchor with, and a frequent anchor is split by AQE since the
    lexicon side holds few rows per anchor.
    """
    runs = F.filter(F.split(F.col("alias"), "[^a-z]+"), lambda w: F.length(w) > 0)
    longest = F.array_max(F.transform(runs, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    latin = F.col("alias").rlike(LATIN_ALIAS)
    anchored = lexicon.withColumns({
        "_latin": latin,
        "_anchor": F.when(latin & longest.isNotNull(), F.concat(F.lit("w:"), longest["w"])).otherwise(
            F.concat(F.lit("c:"), F.regexp_extract("alias", f"{TELLING}[\\s\\S]?", 0))),
        "_pattern": F.concat(
            F.lit("(?<![a-z])"), F.regexp_replace("alias", r"([()\-])", r"\\$1"), F.lit("(?![a-z])")),
    })
    body = F.col(text)
    pieces = F.array_distinct(F.concat(
        F.regexp_extract_all(body, F.lit(f"(?=({TELLING}[\\s\\S]))"), F.lit(1)),
        F.regexp_extract_all(body, F.lit(f"({TELLING})"), F.lit(1)),
    ))
    offered = F.concat(
        F.transform(letter_runs(body), lambda w: F.concat(F.lit("w:"), w)),
        F.transform(pieces, lambda p: F.concat(F.lit("c:"), p)),
    )
    probe = texts.select(key, *([F.col(scope).alias("_scope")] if scope else []),
                         F.explode(offered).alias("_offer"))
    on = F.col("_offer") == F.col("_anchor")
    if scope:
        on = on & (F.col("_scope") == F.col("scope"))
    # An alias that is its own anchor is settled by the join. Only the other
    # candidates meet their text again.
    candidates = probe.join(anchored, on).select(
        key, "dimension", "scope", "alias", "canonical", "_latin", "_pattern",
        (F.col("_anchor") == F.concat(F.lit("w:"), F.col("alias"))).alias("_sure"),
    ).distinct()
    bodies = texts.select(F.col(key).alias("_key"), body.alias("_body"))
    low = F.lower("_body")
    exact = F.when(
        F.col("_latin"), F.contains(low, F.col("alias")) & F.regexp_like(low, F.col("_pattern"))
    ).otherwise(F.contains(F.col("_body"), F.col("alias")))
    return (
        candidates.join(bodies, (F.col(key) == F.col("_key")) & ~F.col("_sure"), "left")
        .where(F.col("_sure") | exact)
        .select(key, "dimension", "scope", "alias", "canonical")
    )


# -- hygiene --------------------------------------------------------------------

def alias_collisions(lexicon: DataFrame) -> DataFrame:
    """Names of one concept that mention an alias of another in the same
    dimension and scope; each would resolve to both."""
    names = lexicon.groupBy("dimension", "scope", "canonical").agg(F.min("name").alias("name")).select(
        F.struct("dimension", "scope", "canonical", "name").alias("_named"), F.lower("name").alias("text"))
    hits = match_by_join(names, lexicon, "_named")
    named = F.col("_named")
    return hits.where(
        (named["dimension"] == F.col("dimension")) & (named["scope"] == F.col("scope"))
        & (named["canonical"] != F.col("canonical"))
    ).select("dimension", "scope", named["canonical"].alias("named"), "alias", "canonical")


def shared_aliases(lexicon: DataFrame) -> DataFrame:
    """Aliases that stand in more than one dimension."""
    return (
        lexicon.groupBy("alias").agg(F.array_sort(F.collect_set("dimension")).alias("dimensions"))
        .where(F.size("dimensions") > 1)
    )


def short_aliases(lexicon: DataFrame, below: int = 3) -> DataFrame:
    """Aliases outside Latin short enough to fall inside longer words."""
    return lexicon.where(~F.col("alias").rlike(LATIN_ALIAS) & (F.length("alias") < below))
