"""Page text to passages: split where the crop changes, merge to a workable size.

Three folds over arrays, as native expressions: lines to runs of lines about the same crops, runs to pieces that can
stand alone, pieces to passages. Runs and pieces are numbers of lines with a length and their crops, so a fold moves no
text; text is put together once for each piece. The crops of a piece are the union of its lines' crops, since no alias
spans a line end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, WS_CHARS, let, lines_of, strip
from ..settings import Settings
from .lexicon import Lexicon, Matcher, per_part, to_canonical

#: Lines `a` to `z` of a page, `n` characters with the line ends between them, and the crops they name.
_PART = "struct<a:int,z:int,n:int,block:int,c:array<string>>"
_NO_CROPS = "cast(array() as array<string>)"


def line_crops(text: Column, lexicon: Lexicon) -> Column:
    """Crops named by each line, as arrays of slugs; null when the page names
    none, which spares such pages the per-line work."""
    rows, matcher = lexicon.rows("subject"), Matcher(lexicon.aliases("subject"))

    def by_line(hits):
        slugs = F.transform(per_part(lines_of(text), hits, matcher.runs or None), lambda found: to_canonical(found, rows))
        return F.when(F.size(hits) > 0, slugs)

    return let(matcher.mentions(text), by_line)


def page_lines(text: Column, crops: Column) -> Column:
    """Lines as structs: number, text (null for a blank one), crops. A block is what stands between blank lines; white
    space at its two ends goes."""
    trimmed = F.lit(WS_CHARS)

    def all_lines(lines):
        def one(line, i):
            blank = lambda at: F.coalesce(strip(F.get(lines, at)) == "", F.lit(True))
            head = F.when(blank(i - 1), F.ltrim(line, trimmed)).otherwise(line)
            return F.struct(i.alias("i"), F.when(~blank(i), F.when(blank(i + 1), F.rtrim(head, trimmed)).otherwise(head)).alias("t"),
                            F.coalesce(F.get(crops, i), F.expr(_NO_CROPS)).alias("c"))

        return F.transform(lines, one)

    return let(lines_of(text), all_lines)


def _part(a, z, n, block, c) -> Column:
    return F.struct(a.alias("a"), z.alias("z"), n.alias("n"), block.alias("block"), c.alias("c"))


def _fold(items: Column, kind: str, step) -> Column:
    """Fold items into an array of parts of type `kind`; the open part is null or what may still grow. `step` gives the
    open part that follows, and whether the one before is closed by it."""
    zero = F.expr(f"named_struct('done', cast(array() as array<{kind}>), 'open', cast(null as {kind}))")
    closed = lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"]))

    def merge(s, item):
        after, closes = step(s["open"], item)
        return F.struct(F.when(closes, closed(s)).otherwise(s["done"]).alias("done"), after.cast(kind).alias("open"))

    return F.aggregate(items, zero, merge, closed)


def runs(lines: Column, least: int) -> Column:
    """Runs of lines. One ends at a blank line, and before a line that names only other crops, if it can stand alone."""
    def step(run, line):
        other = (F.size(run["c"]) > 0) & (F.size(line["c"]) > 0) & ~F.arrays_overlap(run["c"], line["c"]) & (run["n"] >= least)
        # a blank line leaves an empty run, which tells where a block began
        begins = run.isNull() | other | run["z"].isNull()
        block = F.coalesce(run["block"], F.lit(0)) + F.coalesce(run["z"].isNull(), F.lit(False)).cast("int")
        fresh = _part(line["i"], line["i"], F.length(line["t"]), block, line["c"])
        grown = _part(run["a"], line["i"], run["n"] + 1 + F.length(line["t"]), run["block"], F.array_union(run["c"], line["c"]))
        none = F.lit(None).cast("int")
        gap = _part(none, none, F.lit(0), block, F.expr(_NO_CROPS))
        return (F.when(line["t"].isNull(), gap).when(begins, fresh).otherwise(grown),
                F.coalesce(line["t"].isNull() | begins, F.lit(True)))

    return F.filter(_fold(lines, _PART, step), lambda r: r["z"].isNotNull())


def pieces(of_runs: Column, least: int) -> Column:
    """Runs of one block joined while either of two neighbours is too short to stand alone."""
    def step(piece, run):
        joins = F.coalesce((piece["block"] == run["block"]) & (F.least(piece["n"], run["n"]) < least), F.lit(False))
        both = _part(piece["a"], run["z"], piece["n"] + 1 + run["n"], run["block"], F.array_union(piece["c"], run["c"]))
        return F.when(joins, both).otherwise(run), ~joins

    return _fold(of_runs, _PART, step)


def slices(text: Column, most: int) -> Column:
    """A text in parts of at most `most` characters, each ending at the last line end within reach if there is one.

    The first cut is made by itself, since it is of a text not yet stripped. What is left is cut in one walk, whose time
    is in proportion to the text: cutting one part off the rest at a time goes over the rest once for each part."""
    reach = F.substring(text, 1, most)
    back = F.instr(F.reverse(reach), "\n")
    end = F.when((back > 0) & (back < most), most - back).otherwise(F.lit(most))

    def cut(at):
        rest = strip(F.substring(text, at + 1, F.length(text)))
        part = f"(?s)[{WS}]*+(.{{1,{most}}}+\\z|" + (f".{{1,{most - 1}}}(?=\n)|" if most > 1 else "") + f".{{{most}}})"
        return F.concat(F.array(strip(F.substring(text, F.lit(1), at))), let(rest, lambda r: F.when(r == "", F.array(r)).otherwise(
            F.transform(F.regexp_extract_all(r, F.lit(part), F.lit(1)), strip))))

    return F.when(F.length(text) > most, let(end, cut)).otherwise(F.array(text))


def passages(texts: Column, least: int, most: int) -> Column:
    """Pieces (t, c) become passages of workable size. A piece that is too long is sliced; its slices but the last are
    finished, and all have the crops of the whole. Any other piece goes to the passage before, if that may grow."""
    kind = "struct<t:string,c:array<string>>"
    zero = F.expr(f"named_struct('done', cast(array() as array<string>), 'open', cast(null as {kind}))")

    def merge(s, piece):
        own = s["open"]
        elsewhere = (F.size(own["c"]) > 0) & (F.size(piece["c"]) > 0) & ~F.arrays_overlap(own["c"], piece["c"])
        grows = F.coalesce((own["t"] != "") & (F.length(own["t"]) + 2 + F.length(piece["t"]) <= most)
                           & ~(elsewhere & (F.length(own["t"]) >= least)), F.lit(False))
        before = F.when(own.isNull(), s["done"]).otherwise(F.array_append(s["done"], own["t"]))
        sliced = lambda parts: F.struct(
            F.concat(before, F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("done"),
            F.struct(F.element_at(parts, -1).alias("t"), piece["c"].alias("c")).cast(kind).alias("open"))
        grown = F.struct(s["done"].alias("done"), F.struct(F.concat(own["t"], F.lit("\n\n"), piece["t"]).alias("t"),
                                                           F.array_union(own["c"], piece["c"]).alias("c")).cast(kind).alias("open"))
        return F.when(grows, grown).otherwise(let(slices(piece["t"], most), sliced))

    ended = lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"]["t"]))
    return F.filter(F.aggregate(texts, zero, merge, ended), lambda t: F.length(t) >= least)


def page_passages(text: Column, crops: Column, least: int, most: int) -> Column:
    """Passages of one page, in order. `crops` follows the page's lines, or is null."""
    def of_lines(lines):
        def piece(p):
            whole = F.transform(F.slice(lines, p["a"] + 1, p["z"] - p["a"] + 1), lambda line: line["t"])
            return F.struct(F.array_join(whole, "\n").alias("t"), p["c"].alias("c"))

        return passages(F.transform(pieces(runs(lines, least), least), piece), least, most)

    return F.coalesce(let(page_lines(text, crops), of_lines), F.expr(_NO_CROPS))


def with_blocks(pages: DataFrame, lexicon: Lexicon, settings: Settings) -> DataFrame:
    """Add `blocks`, the passages of each page in order."""
    crops = line_crops(F.col("text"), lexicon)
    return pages.withColumn("blocks", let(F.struct(crops.alias("c")), lambda x: page_passages(
        F.col("text"), x["c"], settings.min_passage_chars, settings.max_passage_chars)))
