"""Exact linear-interpolated quantiles without sorting or collecting whole groups.

The built-in exact percentile keeps every distinct value of a group in one task. Here
a group is narrowed to the few cells that hold the wanted ranks:

1. count rows per (group, cell), where a cell is an order-preserving coarse key; the
   map-side combine leaves at most a few thousand entries per group;
2. running totals over the cells tell which cells hold the wanted ranks;
3. while one of those cells is too full, cut it into finer cells and count again;
4. only rows in the chosen cells are counted per distinct value and ranked. If every
   chosen cell holds a single value, step 2 already has the answer.

A hot group costs no more than any other, since steps 1 and 4 combine before they
shuffle and no step orders a whole group.
"""

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.numeric import known
from forecourt.operators.lookup import bounded

CELL_ROWS = 2_000_000
_CELLS_PER_LOG_UNIT = 256
_SUBCELLS = 4096
_MAX_ROUNDS = 6
_WIDE = 16

_VALUE, _WEIGHT, _N, _WANTED = "_value", "_weight", "_n", "_wanted"
_LOW, _HIGH, _ALL = "_low", "_high", "_all"


def _log_cell(value: Column) -> Column:
    size = F.least(F.log1p(F.abs(value)), F.lit(710.0))
    return (F.signum(value) * F.floor(size * _CELLS_PER_LOG_UNIT)).cast("int")


def _sub_cell(value: Column) -> Column:
    low, high = F.col(_LOW), F.col(_HIGH)
    share = F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))
    return F.least(F.floor(share * _SUBCELLS), F.lit(_SUBCELLS - 1)).cast("int")


def _positions(ps: Sequence[float], total: Column) -> Column:
    """The two neighbouring 0-based ranks of every quantile, with the weight between."""

    def ranks(p: Column, i: Column) -> Column:
        at = p * (total - 1)
        return F.array(*[
            F.struct(
                i.alias("i"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"),
                (at - F.floor(at)).alias("weight"),
            )
            for side, rank in ((0, F.floor(at)), (1, F.ceil(at)))
        ])

    return F.flatten(F.transform(F.array(*[F.lit(float(p)) for p in ps]), ranks))


def _locate(counts: DataFrame, keys: Sequence[str], order: str,
            ps: Sequence[float]) -> DataFrame:
    """Keep the entries that hold wanted ranks, with the ranks counted from their start.

    ``counts`` either carries the wanted ranks of its group or gets them here.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    counts = counts.withColumn(
        "_end", F.sum(_N).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    if _WANTED not in counts.columns:
        total = F.sum(_N).over(Window.partitionBy(*keys))
        counts = counts.withColumn("_total", total).withColumn(_WANTED, _positions(ps, F.col("_total"))).drop("_total")
    start, end = F.col("_end") - F.col(_N), F.col("_end")
    held = F.filter(_WANTED, lambda w: (w["rank"] >= start) & (w["rank"] < end))
    return (
        counts.withColumn(
            _WANTED, F.transform(held, lambda w: w.withField("rank", w["rank"] - start))
        )
        .where(F.size(_WANTED) > 0)
        .drop("_end")
    )


def _interpolate(picked: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    rows = picked.select(*keys, F.col(_VALUE), F.explode(_WANTED).alias("w"))
    if len(names) > _WIDE:
        # Two entries per quantile in the order of (i, side); so many aggregates would compile for long.
        entry = F.struct("w.i", "w.side", F.col(_VALUE).alias("v"), "w.weight")
        listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("e"))
        lows = F.filter("e", lambda x: x["side"] == 0)
        highs = F.filter("e", lambda x: x["side"] == 1)
        values = F.zip_with(lows, highs, lambda a, b: a["v"] + (b["v"] - a["v"]) * a["weight"])
        listed = listed.select(*keys, values.alias("e"))
        return listed.select(*keys, *[F.get("e", i).alias(name) for i, name in enumerate(names)])
    columns = []
    for i, name in enumerate(names):
        mine = F.col("w.i") == i
        low = F.max(F.when(mine & (F.col("w.side") == 0), F.col(_VALUE)))
        high = F.max(F.when(mine & (F.col("w.side") == 1), F.col(_VALUE)))
        weight = F.max(F.when(mine, F.col("w.weight")))
        columns.append((low + (high - low) * weight).alias(name))
    return rows.groupBy(*keys).agg(*columns)


def _with_wanted(counts: DataFrame, located: DataFrame | None, on: Sequence[str]) -> DataFrame:
    """Attach the ranks wanted from each cell, after the aggregation: carried through it,
    the array would turn hash aggregation into sorting."""
    if located is None:
        return counts
    return counts.join(located.select(*on, _WANTED), list(on))


def _fullest(located: DataFrame, head: pa.Table | None) -> int | None:
    """Rows in the fullest cell with more than one distinct value, if there is one."""
    if head is None:
        return located.where(F.col(_LOW) < F.col(_HIGH)).agg(F.max(_N)).first()[0]
    return pc.max(head.filter(pc.less(head[_LOW], head[_HIGH]))[_N]).as_py()


def _named(ps: Mapping[str, float] | Sequence[float]) -> dict[str, float]:
    if isinstance(ps, Mapping):
        return dict(ps)
    return {f"p{100 * p:g}".replace(".", "_"): p for p in ps}


def quantiles(df: DataFrame, col: str, ps: Mapping[str, float] | Sequence[float],
              by: Sequence[str] | str = (), weight: str | None = None,
              cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per group with one column per quantile; missing values and keys drop out.

    ``weight`` is a column of repeat counts for a table that is already aggregated.
    The counting rounds run when this is called; the last one is left to the caller's
    action.
    """
    by = [by] if isinstance(by, str) else list(by)
    named = _named(ps)
    fractions, names = list(named.values()), list(named)
    keys = by or [_ALL]

    repeats = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*by, known(F.col(col)).alias(_VALUE), repeats.cast("bigint").alias(_WEIGHT))
    for name in (*by, _VALUE):
        rows = rows.where(F.col(name).isNotNull())
    if not by:
        rows = rows.withColumn(_ALL, F.lit(0))

    cells: list[str] = []
    located = None
    for depth in range(_MAX_ROUNDS):
        cell = f"_cell{depth}"
        key = _log_cell(F.col(_VALUE)) if depth == 0 else _sub_cell(F.col(_VALUE))
        rows = rows.withColumn(cell, key)
        counts = rows.groupBy(*keys, *cells, cell).agg(
            F.sum(_WEIGHT).alias(_N), F.min(_VALUE).alias(_LOW), F.max(_VALUE).alias(_HIGH)
        )
        counts = _with_wanted(counts, located, [*keys, *cells])
        located, head = bounded(_locate(counts, [*keys, *cells], cell, fractions))
        cells.append(cell)
        fullest = _fullest(located, head)
        if fullest is None:
            picked = located.withColumn(_VALUE, F.col(_LOW))
            return _interpolate(picked, keys, names).select(*by, *names)
        rows = rows.drop(_LOW, _HIGH).join(located.drop(_N, _WANTED), [*keys, *cells])
        if fullest <= cell_rows:
            break

    values = rows.groupBy(*keys, *cells, _VALUE).agg(F.sum(_WEIGHT).alias(_N))
    values = _with_wanted(values, located, [*keys, *cells])
    picked = _locate(values, [*keys, *cells], _VALUE, fractions)
    return _interpolate(picked, keys, names).select(*by, *names)


def median(df: DataFrame, col: str, by: Sequence[str] | str = (), name: str = "median",
           weight: str | None = None) -> DataFrame:
    return quantiles(df, col, {name: 0.5}, by, weight)


def approximate_quantiles(df: DataFrame, col: str, ps: Mapping[str, float] | Sequence[float],
                          by: Sequence[str] | str = (), accuracy: int = 10_000) -> DataFrame:
    """Single-scan alternative with rank error at most ``1 / accuracy``."""
    by = [by] if isinstance(by, str) else list(by)
    named = _named(ps)
    rows = df.select(*by, known(F.col(col)).alias(_VALUE)).dropna()
    sketch = F.percentile_approx(_VALUE, list(named.values()), accuracy).alias("_qs")
    grouped = rows.groupBy(*by).agg(sketch)
    return grouped.select(*by, *[F.col("_qs")[i].alias(n) for i, n in enumerate(named)])
