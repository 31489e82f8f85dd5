"""Shared parts of the comparison statements."""

from __future__ import annotations

from .. import corpus

WS = r"\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{001C}-\x{001F}"


def tidy(x: str) -> str:
    x = rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[ \t\x{{00A0}}]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '(?m)^[{WS}•●▪\-*→]+', '', 'g')"
    x = rf"regexp_replace({x}, '(?m) +$', '', 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(x)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def slug(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


def uuid5(name: str) -> str:
    h = f"sha1(unhex('6f1d3c621f2a5b7e9c110a2b3c4d5e6f') || encode({name}))"
    v = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (f"substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
            f"{v} || substr({h},18,3) || '-' || substr({h},21,12)")


def literal(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def lexicon() -> str:
    rows = ",\n".join("(" + ",".join(map(literal, e)) + ")" for e in corpus.LEXICON.entries)
    return f"lex(dimension, scope, alias, canonical, name, kind) as (values {rows})"


def mentions(text: str, alias: str = "alias") -> str:
    return (f"(case when regexp_matches({alias}, '^[a-z0-9 ()\\-'']+$') then contains(lower({text}), {alias}) and "
            f"regexp_matches(lower({text}), '(^|[^a-z])' || regexp_escape({alias}) || '([^a-z]|$)') "
            f"else contains({text}, {alias}) end)")


PAGES = f"""pages_ as (select source as document, doc_id as page, {tidy('text')} as text from documents)"""


def state_of(head: str, name: str) -> str:
    whens = []
    for s in corpus.STATES:
        tests = " or ".join(f"contains({head}, {literal(m)}) or contains(lower({name}), {literal(m)})" for m in s.markers)
        whens.append(f"when {tests} then '{s.code}'")
    return "case " + " ".join(whens) + " end"


STATE = f"""states_ as (select document, {state_of("string_agg(lower(text), chr(10))", "document")} as state_code
  from (select *, row_number() over (partition by document order by page) rn from pages_) where rn <= 4 group by document)"""

GATE = r"""gate_ as (select document, count(*) as pages, count(*) filter (length(text) >= 40) as usable from pages_ group by 1),
accepted_ as (select p.*, s.state_code from pages_ p join gate_ g using (document) join states_ s using (document)
  where g.usable > 0 and g.usable / g.pages >= 0.5 and s.state_code is not null)"""

# Lines of accepted pages, each taken as a passage.
LINES = """lined_ as (select document, page, state_code, unnest(string_split(text, chr(10))) as text,
    unnest(range(len(string_split(text, chr(10))))) as i from accepted_),
rows_ as (select document, page, page * 100000 + i as ordinal, text, state_code, cast([] as varchar[]) as section
  from lined_)"""


def facets(rows: str = "rows_") -> str:
    """Facets of rows(document, page, ordinal, text, state_code, section)."""
    livestock = ", ".join(sorted({literal(e[3]) for e in corpus.LEXICON.rows("subject") if e[5] == "livestock"}))
    garden = ", ".join(map(literal, corpus.HORTICULTURE))
    return f"""hits_ as (select distinct r.document, r.ordinal, l.dimension, l.canonical from {rows} r join lex l
    on (l.dimension <> 'district' or l.scope = r.state_code) and {mentions('r.text', 'l.alias')}),
lists_ as (select document, ordinal,
    list(canonical order by canonical) filter (dimension = 'subject') as subj,
    list(canonical order by canonical) filter (dimension = 'topic') as topic,
    list(canonical order by canonical) filter (dimension = 'weather') as wx,
    list(canonical order by canonical) filter (dimension = 'district') as dist from hits_ group by 1, 2),
found_ as (select r.*, coalesce(subj, []) as subj, coalesce(topic, []) as topics, coalesce(wx, []) as wx, coalesce(dist, []) as dist
  from {rows} r left join lists_ using (document, ordinal)),
placed_ as (select *,
    case when len(section) > 0 then section[1] when len(dist) = 1 then dist[1] else state_code end as area_code,
    case when len(section) > 0 then list_concat(section[2:], dist) when len(dist) = 1 then [] else dist end as also0,
    case when list_has_any(subj, [{livestock}]) then 'Livestock'
         when len(subj) > 0 and len(list_filter(subj, lambda s: not list_contains([{garden}], s))) = 0 then 'Horticulture'
         when len(subj) > 0 then 'Crop'
         when list_contains(topics, 'LivestockCare') then 'Livestock' else 'Weather' end as category from found_),
facets_ as (select document, page, ordinal, text, state_code, area_code, category, topics, 'en' as language,
    list_filter(also0, lambda x, i: x <> area_code and list_position(also0, x) = i) as also,
    case when category = 'Weather' then [] else subj end as subjects,
    case when category = 'Weather' then wx else [] end as weather,
    'res-corpus-field-notes-' || {slug('category')} || '-' || {slug('area_code')} as resource_id from placed_)"""


NAMES = ("areas_(code, name, level) as (values "
         + ", ".join(f"({literal(s.code)}, {literal(s.name)}, 'State')" for s in corpus.STATES) + ", "
         + ", ".join(sorted({f"({literal(e[3])}, {literal(e[4])}, 'District')" for e in corpus.LEXICON.rows("district")})) + ")")

LINE_FACETS = ",\n".join([lexicon(), PAGES, STATE, GATE, LINES, facets()])


def joined(x: str) -> str:
    return f"array_to_string({x}, ',')"
