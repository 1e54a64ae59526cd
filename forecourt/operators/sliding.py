"""Exact statistics over a sliding range of an integer column, such as the model years around a year.

A row belongs to up to ``2 * reach + 1`` ranges, yet no row is repeated. Rows are counted per
(group, place, cell) first, with the cells of :mod:`quantiles`, and these counts are added up for
every range. Only cells that a range must look into, since they hold a wanted rank or a fence, are
cut finer or counted by distinct value, and only those counts are spread over the ranges.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.numeric import known
from forecourt.operators.lookup import bounded
from forecourt.operators.quantiles import (
    _HIGH, _LOW, _MAX_ROUNDS, _N, _VALUE, _WANTED, CELL_ROWS, _fullest, _interpolate, _locate, _log_cell,
    _named, _sub_cell, _with_wanted,
)

_CELL, _SUM = "_cell0", "_sum"


def _rows(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    rows = df.select(*keys, known(F.col(col)).alias(_VALUE))
    for name in (*keys, _VALUE):
        rows = rows.where(F.col(name).isNotNull())
    return rows.withColumn(_CELL, _log_cell(F.col(_VALUE)))


def _counted(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.groupBy(*on).agg(
        F.count(F.lit(1)).alias(_N), F.min(_VALUE).alias(_LOW), F.max(_VALUE).alias(_HIGH), F.sum(_VALUE).alias(_SUM)
    )


def _spread(df: DataFrame, along: str, reach: int) -> DataFrame:
    """Every entry under each place whose range it is in; the relation is its own inverse."""
    return df.withColumn(along, F.explode(F.sequence(F.col(along) - reach, F.col(along) + reach)))


def _added(counts: DataFrame, on: Sequence[str]) -> DataFrame:
    return counts.groupBy(*on).agg(
        F.sum(_N).alias(_N), F.min(_LOW).alias(_LOW), F.max(_HIGH).alias(_HIGH), F.sum(_SUM).alias(_SUM)
    )


def _members(rows: DataFrame, cells: DataFrame, on: Sequence[str], along: str, reach: int,
             keep: Sequence[str] = ()) -> DataFrame:
    """The rows in any of ``cells`` (of ranges), once each whatever the number of ranges."""
    wanted = _spread(cells.select(*on, *keep), along, reach).distinct()
    return rows.join(bounded(wanted)[0], list(on))


def cell_counts(df: DataFrame, col: str, by: Sequence[str], along: str) -> DataFrame:
    """Rows, least and largest value and sum per (group, place, cell); missing values and keys drop out."""
    keys = [*by, along]
    return _counted(_rows(df, col, keys), [*keys, _CELL])


def sliding_totals(counts: DataFrame, by: Sequence[str], along: str, reach: int) -> DataFrame:
    """``count``, ``min`` and ``max`` of every range that holds a row, from :func:`cell_counts`."""
    keys = [*by, along]
    per_place = _added(counts, keys)
    return _added(_spread(per_place, along, reach), keys).select(
        *keys, F.col(_N).alias("count"), F.col(_LOW).alias("min"), F.col(_HIGH).alias("max")
    )


def sliding_quantiles(df: DataFrame, col: str, ps: Mapping[str, float] | Sequence[float], by: Sequence[str],
                      along: str, reach: int, counts: DataFrame | None = None,
                      cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per (group, place) whose range ``place - reach`` to ``place + reach`` holds a row.

    ``counts`` is a stored result of :func:`cell_counts`, which saves a scan. The counting rounds
    run when this is called.
    """
    keys, named = [*by, along], _named(ps)
    fractions, names = list(named.values()), list(named)
    rows = _rows(df, col, keys)
    counts = _counted(rows, [*keys, _CELL]) if counts is None else counts

    cells: list[str] = []
    located = None
    for depth in range(_MAX_ROUNDS):
        cell = f"_cell{depth}"
        if depth:
            rows = rows.withColumn(cell, _sub_cell(F.col(_VALUE))).drop(_LOW, _HIGH)
            counts = _counted(rows, [*keys, *cells, cell])
        ranges = _spread(counts, along, reach)
        if located is not None:
            ranges = ranges.join(located.select(*keys, *cells), [*keys, *cells], "left_semi")
        ranges = _with_wanted(_added(ranges, [*keys, *cells, cell]), located, [*keys, *cells])
        located, head = bounded(_locate(ranges.drop(_SUM), [*keys, *cells], cell, fractions))
        cells.append(cell)
        fullest = _fullest(located, head)
        if fullest is None:
            return _interpolate(located.withColumn(_VALUE, F.col(_LOW)), keys, names)
        # One pair of borders per cell for all places, so that finer cells can be added up too.
        everywhere = Window.partitionBy(*by, *cells)
        borders = located.withColumns({_LOW: F.min(_LOW).over(everywhere), _HIGH: F.max(_HIGH).over(everywhere)})
        rows = _members(rows, borders, [*keys, *cells], along, reach, [_LOW, _HIGH])
        if fullest <= cell_rows:
            break

    on = [*keys, *cells]
    values = rows.groupBy(*on, _VALUE).agg(F.count(F.lit(1)).alias(_N))
    values = _spread(values, along, reach).join(located.select(*on), on, "left_semi")
    values = _with_wanted(values.groupBy(*on, _VALUE).agg(F.sum(_N).alias(_N)), located.select(*on, _WANTED), on)
    return _interpolate(_locate(values, on, _VALUE, fractions), keys, names)


def sliding_boxes(df: DataFrame, col: str, by: Sequence[str], along: str, reach: int, counts: DataFrame,
                  k: float = 1.5) -> DataFrame:
    """The columns of :func:`distribution.box_stats` for every range; ``counts`` as above.

    Cells wholly inside or outside the fences are settled by their counts; cells a fence runs
    through are counted by distinct value.
    """
    keys = [*by, along]
    on = [*keys, _CELL]
    spread = k * (F.col("q3") - F.col("q1"))
    boxes = bounded(
        sliding_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, along, reach, counts)
        .withColumns({"_from": F.col("q1") - spread, "_to": F.col("q3") + spread})
    )[0]
    ranges = _added(_spread(counts, along, reach), on).join(boxes.select(*keys, "_from", "_to"), keys)
    low, high = F.col(_LOW), F.col(_HIGH)
    inside = (low >= F.col("_from")) & (high <= F.col("_to"))
    outside = (high < F.col("_from")) | (low > F.col("_to"))
    cut = bounded(ranges.where(~inside & ~outside).select(*on, "_from", "_to"))[0]

    values = _counted(_members(_rows(df, col, keys), cut, on, along, reach), [*on, _VALUE]).drop(_VALUE)
    pieces = _spread(values, along, reach).join(cut, on)
    settled = ranges.where(inside | outside)
    return (
        settled.unionByName(pieces)
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside, low)).alias("whisker_low"), F.max(F.when(inside, high)).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col(_N))).alias("n_outliers"),
            (F.sum(_SUM) / F.sum(_N)).alias("mean"), F.sum(_N).alias("count"),
        )
        .join(boxes.drop("_from", "_to"), keys)
        .select(*keys, "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers", "mean", "count")
    )
