"""Running values along an order, for keys of any size.

A plain window puts a whole key into one task. Here positions are cut into
chunks: a window runs inside each chunk, one summary row per chunk carries its
total onwards, and the two are joined on (key, chunk). A key with a third of all
rows is spread over as many tasks as it has chunks. The summaries are cut into
chunks again, so the last window sees one row per chunk of chunks: with chunks of
1024, a trillion rows of one key leave a million rows for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Before = Window.unboundedPreceding


def running(df: DataFrame, key: str, position: str, *, chunk: int,
            fill: dict[str, str] | None = None, totals: dict[str, str] | None = None,
            inclusive: bool = True, levels: int = 2) -> DataFrame:
    """Add carried values to `df`, which must be cheap to read twice.

    `fill` maps an input column to the name of its last non-null value before
    the row, or at it when `inclusive`; `totals` maps a count column to the name of its sum over the
    rows strictly before. (key, position) is unique and position is integral.
    """
    fill, totals = fill or {}, totals or {}
    cut = F.expr(f"`{position}` div {chunk}")  # integer division keeps large positions exact
    rows = df.withColumn("_chunk", cut)
    inside = Window.partitionBy(key, "_chunk").orderBy(position)
    local = rows.withColumns({
        **{f"_f_{new}": F.last(src, ignorenulls=True).over(inside.rowsBetween(Before, 0 if inclusive else -1))
           for src, new in fill.items()},
        **{f"_t_{new}": F.coalesce(F.sum(src).over(inside.rowsBetween(Before, -1)), F.lit(0))
           for src, new in totals.items()},
    })
    summary = rows.groupBy(key, "_chunk").agg(
        *[F.max_by(src, F.when(F.col(src).isNotNull(), F.col(position))).alias(f"_s_{new}")
          for src, new in fill.items()],
        *[F.sum(src).alias(f"_s_{new}") for src, new in totals.items()],
    )
    if levels > 1:
        renamed = summary.withColumnRenamed("_chunk", "_at")
        carried = running(
            renamed, key, "_at", chunk=chunk, inclusive=False, levels=levels - 1,
            fill={f"_s_{n}": f"_c_{n}" for n in fill.values()},
            totals={f"_s_{n}": f"_c_{n}" for n in totals.values()},
        ).select(key, F.col("_at").alias("_chunk"), *[f"_c_{n}" for n in [*fill.values(), *totals.values()]])
    else:
        earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Before, -1)
        carried = summary.select(
            key, "_chunk",
            *[F.last(f"_s_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in fill.values()],
            *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in totals.values()],
        )
    out = local.join(carried, [key, "_chunk"], "left").withColumns({
        **{new: F.coalesce(f"_f_{new}", f"_c_{new}") for new in fill.values()},
        **{new: (F.col(f"_t_{new}") + F.col(f"_c_{new}")).cast("long") for new in totals.values()},
    })
    hidden = ["_chunk"] + [f"_{p}_{n}" for n in fill.values() for p in "fc"] + [
        f"_{p}_{n}" for n in totals.values() for p in "tc"]
    return out.drop(*hidden)


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key. Spark applies the rank limit before the
    shuffle, so a hot key sends one row per input task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
