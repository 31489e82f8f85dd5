"""Validation as queries: every rule yields (catalog_id, resource_id, rule, detail).

Rules about one resource are expressions over its own row, gathered in one array
and exploded: one scan for all of them. Only duplicates and directives need an
aggregate or a join.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prose import CLOSED_KEYS, STRUCTURAL_KEYS, has_advice, is_duration, is_language_code, is_prose
from ..functions.text import capability_of, string_array
from ..settings import Settings
from .lexicon import Lexicon

# Attribute groups that belong to some capabilities only.
GROUPS = ("agricultureSubjects", "weatherParameters", "topics")
# Levels an area may have, and the two catalogue types.
LEVELS = ("State", "District")
CATALOG_TYPES = ("MASTER", "REGULAR")

KNOWN_ATTRIBUTES = (
    "@context", "@type", "subjectCategories", "languages", "coverageAreas", "geographicGranularity",
    "agricultureSubjects", "weatherParameters", "topics", "evidence", "updateFrequency", "forecastHorizon",
)

VIOLATION = "array<struct<rule:string,detail:string>>"


class InvalidPayload(ValueError):
    """Raised instead of publishing."""


def _one(when: Column, rule: str, detail: Column | str) -> Column:
    text = F.lit(detail) if isinstance(detail, str) else detail
    hit = F.struct(F.lit(rule).alias("rule"), F.coalesce(text, F.lit("null")).alias("detail"))
    return F.when(F.coalesce(when, F.lit(False)), F.array(hit)).otherwise(F.array().cast(VIOLATION))


def _each(values: Column, bad, rule: str, detail) -> Column:
    """One violation per offending element."""
    offending = F.filter(F.coalesce(values, values), bad)
    out = F.transform(offending, lambda v: F.struct(
        F.lit(rule).alias("rule"), F.coalesce(detail(v), F.lit("null")).alias("detail")))
    return F.coalesce(out, F.array().cast(VIOLATION))


def _not_in(allowed) -> object:
    allowed = list(allowed)
    return lambda v: v.isNull() | ~v.isin(*allowed) if allowed else F.lit(True)


LEAF = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("text", T.StringType())]))


def open_strings(value: Column, kind: T.DataType, path: Column, key: str = "") -> Column:
    """(path, text) of the string leaves of a typed value that no closed vocabulary covers, as a native expression."""
    none = F.array().cast(LEAF)
    if isinstance(kind, T.StructType):
        parts = [open_strings(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")), f.name)
                 for f in kind.fields if f.name not in STRUCTURAL_KEYS]
        return F.coalesce(F.concat(*parts), none) if parts else none
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType) and key in CLOSED_KEYS:
            return none
        each = F.transform(value, lambda v, i: open_strings(
            v, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), key))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, T.StringType) and key not in CLOSED_KEYS:
        return F.when(value.isNotNull(), F.array(F.struct(path.alias("path"), value.alias("text")))).otherwise(none)
    return none


@F.pandas_udf(LEAF)
def json_strings(bodies: pd.Series) -> pd.Series:
    """The same of a JSON object of unknown keys, whose shape no schema tells. Resources with such keys are few."""
    closed, skip = set(CLOSED_KEYS), set(STRUCTURAL_KEYS)

    def leaves(body):
        todo, found = [(json.loads(body), "resourceAttributes", None)], []
        while todo:
            node, where, key = todo.pop()
            if isinstance(node, dict):
                todo.extend((v, f"{where}.{k}", k) for k, v in node.items() if k not in skip)
            elif isinstance(node, list):
                todo.extend((v, f"{where}[{i}]", key) for i, v in enumerate(node))
            elif isinstance(node, str) and key not in closed:
                found.append({"path": where, "text": node})
        return sorted(found, key=lambda leaf: leaf["path"])

    return pd.Series([leaves(b) if b else [] for b in bodies])


def resource_rules(lexicon: Lexicon, settings: Settings, duration=is_duration) -> Column:
    """All violations of one row of `resources` (columns `attributes`,
    `descriptor`, and optionally `extras`, a JSON object of unknown keys)."""
    a = F.col("attributes")
    allowed_groups = {c.type: c.attribute_groups for c in lexicon.capabilities}
    cap = capability_of(a["@type"])
    known_type = cap.isin(*allowed_groups)
    categories = sorted({s for c in lexicon.capabilities for s in c.subject_categories})
    uris = [f"{settings.taxonomy_base}/{kind}/{slug}"
            for slug, kind in sorted({(e[3], e[5]) for e in lexicon.rows("subject")})]
    areas = sorted({e[3] for e in lexicon.rows("district")} | {s.code for s in lexicon.states})
    schemes = (settings.state_scheme, settings.district_scheme)
    carried = F.array_distinct(F.filter(
        F.transform(F.coalesce(a["agricultureSubjects"], F.array()), lambda s: s["subjectType"]),
        lambda t: t.isNotNull()))

    rules = [
        _one(F.trim(F.coalesce(a["@context"], F.lit(""))) == "", "blank-context", "@context"),
        _one(F.trim(F.coalesce(a["@type"], F.lit(""))) == "", "blank-type", "@type"),
        _one(~known_type, "unknown-type", a["@type"]),
        _one(F.coalesce(F.size(a["coverageAreas"]), F.lit(0)) <= 0, "no-coverage", "coverageAreas"),
        _each(a["coverageAreas"],
              lambda v: (F.coalesce(v["areaCode"], F.lit("")) == "") | (F.coalesce(v["codeScheme"], F.lit("")) == ""),
              "area-incomplete", lambda v: v["areaName"]),
        _one(F.coalesce(F.size(a["languages"]), F.lit(0)) <= 0, "no-language", "languages"),
        _one(F.size(F.array_except(carried, F.coalesce(a["subjectCategories"], F.array().cast("array<string>")))) > 0,
             "undeclared-subject-type",
             F.array_join(F.array_sort(F.array_except(carried, a["subjectCategories"])), ",")),
        _each(a["topics"], _not_in(lexicon.canonicals("topic")), "unknown-topic", lambda v: v),
        _each(a["weatherParameters"], _not_in(lexicon.canonicals("weather")), "unknown-weather", lambda v: v),
        _each(a["subjectCategories"], _not_in(categories), "unknown-category", lambda v: v),
        _each(a["languages"], lambda v: ~is_language_code(v), "bad-language", lambda v: v),
        _one(a["geographicGranularity"].isNull() | ~a["geographicGranularity"].isin(*LEVELS),
             "bad-granularity", a["geographicGranularity"]),
        _one(a["updateFrequency"].isNotNull() & ~duration(a["updateFrequency"]), "bad-duration", a["updateFrequency"]),
        _one(a["forecastHorizon"].isNotNull() & ~duration(a["forecastHorizon"]), "bad-duration", a["forecastHorizon"]),
        _each(a["coverageAreas"], lambda v: _not_in(schemes)(v["codeScheme"]), "unknown-scheme", lambda v: v["codeScheme"]),
        _each(a["coverageAreas"], lambda v: _not_in(LEVELS)(v["areaLevel"]), "unknown-level", lambda v: v["areaLevel"]),
        _each(a["coverageAreas"], lambda v: _not_in(areas)(v["areaCode"]), "unknown-area", lambda v: v["areaCode"]),
        _each(a["agricultureSubjects"], lambda v: _not_in(uris)(v["subjectId"]), "unminted-subject", lambda v: v["subjectId"]),
    ]
    for group in GROUPS:
        serves = cap.isin(*[t for t, g in allowed_groups.items() if group in g])
        rules.append(_one(known_type & a[group].isNotNull() & ~serves, "foreign-group", group))
    for part in ("code", "name", "shortDesc", "longDesc"):
        rules.append(_one(has_advice(F.col("descriptor")[part]), "advice-in-descriptor", f"descriptor.{part}"))
    return F.concat(*rules)


def resource_violations(resources: DataFrame, lexicon: Lexicon, settings: Settings,
                        duration=is_duration) -> DataFrame:
    """V5-V12 of every resource in one pass."""
    missing = F.col("attributes").isNull()
    none = F.array().cast(LEAF)
    named = open_strings(F.col("attributes"), resources.schema["attributes"].dataType, F.lit("resourceAttributes"))
    rows, areas = resources, F.lit(None).cast("array<map<string,string>>")
    unnamed = none
    if "extras" in resources.columns:
        rows = resources.withColumn("_open", json_strings("extras"))
        unnamed = F.coalesce("_open", none)
        areas = F.from_json(F.get_json_object("extras", "$.coverageAreas"), "array<map<string,string>>")
    prose = _each(F.concat(named, unnamed), lambda leaf: is_prose(leaf["text"]), "prose",
                  lambda leaf: F.substring(F.concat(leaf["path"], F.lit(" = "), leaf["text"]), 1, 110))
    geometry = _one(F.exists(areas, lambda area: F.map_contains_key(area, "coordinates")), "coordinates", "coordinates")
    found = F.when(missing, F.array(F.struct(F.lit("no-attributes").alias("rule"), F.lit("").alias("detail")))).otherwise(
        F.concat(resource_rules(lexicon, settings, duration), prose, geometry))
    return rows.select("catalog_id", "resource_id", F.explode(found).alias("v")).select(
        "catalog_id", "resource_id", "v.rule", "v.detail")


def duplicate_ids(resources: DataFrame, *owner: str) -> DataFrame:
    """Resource ids that stand more than once in one catalogue."""
    keys = [*owner, "catalog_id", "resource_id"]
    return resources.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def catalog_violations(catalog_rows: DataFrame) -> DataFrame:
    """V3: a catalogue has resources, and a provider with id and descriptor."""
    c = F.col("catalog")
    rules = F.concat(
        _one(F.coalesce(F.size(c["resources"]), F.lit(0)) <= 0, "no-resources", "resources"),
        _one(F.coalesce(c["provider"]["id"], F.lit("")) == "", "no-provider", "provider.id"),
        _one(c["provider"]["descriptor"].isNull(), "no-provider", "provider.descriptor"),
        _one(F.coalesce(c["id"], F.lit("")) == "", "no-catalog-id", "id"),
        _one(c["descriptor"].isNull(), "no-descriptor", "descriptor"),
    )
    return catalog_rows.select("catalog_id", F.lit(None).cast("string").alias("resource_id"),
                               F.explode(rules).alias("v")).select("catalog_id", "resource_id", "v.rule", "v.detail")


def directive_violations(catalog_ids: DataFrame, directives: DataFrame) -> DataFrame:
    """V2: once there are directives, each catalogue needs one; and their type
    is one of two."""
    any_directive = directives.select(F.count("*").alias("n")).scalar() > 0
    absent = (
        catalog_ids.select("catalog_id").distinct()
        .join(directives.select("catalog_id"), "catalog_id", "left_anti")
        .where(any_directive)
        .select("catalog_id", F.lit("no-directive").alias("rule"), F.col("catalog_id").alias("detail"))
    )
    typed = directives.where(~F.col("catalog_type").isin(*CATALOG_TYPES)).select(
        "catalog_id", F.lit("bad-catalog-type").alias("rule"), F.col("catalog_type").alias("detail"))
    both = absent.unionByName(typed)
    return both.select("catalog_id", F.lit(None).cast("string").alias("resource_id"), "rule", "detail")


def context_violations(envelopes: DataFrame, version: str = "2.0.0") -> DataFrame:
    """V1 and the shape of the envelope itself."""
    c = F.col("context")
    required = ("transactionId", "messageId", "timestamp")
    rules = F.concat(
        _one(c["version"].isNull() | (c["version"] != version), "bad-version", c["version"]),
        _one(c["action"].isNull() | (c["action"] != "publish"), "bad-action", c["action"]),
        *[_one(F.coalesce(c[k], F.lit("")) == "", "missing-context", k) for k in required],
        _one(F.coalesce(F.size("message.catalogs"), F.lit(0)) <= 0, "no-catalogs", "catalogs"),
    )
    none = F.lit(None).cast("string")
    return envelopes.select(F.explode(rules).alias("v")).select(
        none.alias("catalog_id"), none.alias("resource_id"), "v.rule", "v.detail")


def unknown_keys(bodies: DataFrame, body: str, allowed) -> DataFrame:
    """V14: keys a closed object does not have."""
    keys = F.array_except(F.json_object_keys(F.col(body)), string_array(allowed))
    return bodies.select("catalog_id", F.explode(keys).alias("detail")).select(
        "catalog_id", F.lit(None).cast("string").alias("resource_id"),
        F.lit("unknown-key").alias("rule"), "detail")


# The keys of the closed objects of an envelope.
CLOSED_OBJECTS = {
    "context": ("domain", "action", "version", "transactionId", "messageId", "timestamp", "schemaContext"),
    "message": ("catalogs", "publishDirectives"),
    "catalog": ("id", "descriptor", "provider", "isActive", "validity", "resources"),
    "provider": ("id", "descriptor"),
    "directive": ("catalogId", "catalogType", "visibleTo"),
}


def closed_object_violations(envelopes: DataFrame) -> DataFrame:
    """V14 for every closed object of the envelopes, by the keys its JSON form has."""
    none = F.lit(None).cast("string")
    bodies = [envelopes.select(none.alias("catalog_id"), F.to_json(part).alias("body"), F.lit(part).alias("kind"))
              for part in ("context", "message")]
    each = envelopes.select(F.explode("message.catalogs").alias("c"))
    bodies.append(each.select(F.col("c.id").alias("catalog_id"), F.to_json("c").alias("body"), F.lit("catalog").alias("kind")))
    bodies.append(each.select(F.col("c.id").alias("catalog_id"), F.to_json("c.provider").alias("body"), F.lit("provider").alias("kind")))
    told = envelopes.select(F.explode("message.publishDirectives").alias("d"))
    bodies.append(told.select(F.col("d.catalogId").alias("catalog_id"), F.to_json("d").alias("body"), F.lit("directive").alias("kind")))
    found = [unknown_keys(b, "body", CLOSED_OBJECTS[kind]) for b, kind in zip(bodies, CLOSED_OBJECTS)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def validate(resources: DataFrame, catalog_rows: DataFrame, directives: DataFrame, envelopes: DataFrame,
             lexicon: Lexicon, settings: Settings) -> DataFrame:
    """Every violation of one publish."""
    duplicated = duplicate_ids(resources, "owner").select(
        "catalog_id", "resource_id", F.lit("duplicate-id").alias("rule"), F.col("resource_id").alias("detail"))
    parts = [
        context_violations(envelopes, settings.envelope_version),
        directive_violations(resources.select("catalog_id"), directives),
        catalog_violations(catalog_rows),
        closed_object_violations(envelopes),
        duplicated,
        resource_violations(resources, lexicon, settings),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_valid(violations: DataFrame, shown: int = 20) -> None:
    """Refuse to publish when there is any violation; names the first few."""
    rows = violations.orderBy("catalog_id", "resource_id", "rule", "detail").limit(shown).collect()
    if rows:
        listed = "\n  ".join(f"{r['rule']}: {r['catalog_id']} {r['resource_id']} {r['detail']}" for r in rows)
        raise InvalidPayload("refusing to publish:\n  " + listed)


def summary(resources: DataFrame, violations: DataFrame) -> DataFrame:
    return resources.agg(
        F.countDistinct("catalog_id").alias("catalogs"),
        F.count("*").alias("resources"),
        F.count_if(F.col("attributes").isNotNull()).alias("checked"),
    ).withColumn("errors", violations.agg(F.count("*")).scalar()).withColumn("ok", F.col("errors") == 0)
