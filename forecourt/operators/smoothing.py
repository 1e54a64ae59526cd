"""Locally weighted regression (LOWESS) at fixed nodes: its cost is rows * nodes, not rows²."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import known
from forecourt.operators.quantiles import median, quantiles
from forecourt.session import checkpoint

#: Nodes of a curve, whatever the table: the quantiles of x at equal steps, both ends included.
NODES = 65

_SCHEMA = "x double, fitted double, n bigint"
_SUMS = ("w", "wt", "wy", "wtt", "wty")


def _doubles(values: Sequence[float | None]) -> Column:
    return F.expr(f"array({', '.join('CAST(NULL AS DOUBLE)' if v is None else f'{v!r}D' for v in values)})")


def _beside(per_x: DataFrame, nodes: Sequence[float], widths: Sequence[float]) -> DataFrame:
    """Every row of a table with ``x`` next to every node: distance ``t`` and bandwidth ``h``."""
    pairs = F.arrays_zip(_doubles(nodes).alias("at"), _doubles(widths).alias("h"))
    spread = per_x.select("*", F.posexplode(pairs).alias("node", "p"))
    return spread.withColumn("t", F.col("x") - F.col("p.at")).withColumn("h", F.col("p.h")).drop("p")


def _bandwidths(counts: DataFrame, nodes: Sequence[float], nearest: int, total: int) -> list[float]:
    """Distance from every node to its ``nearest``-th nearest row, an exact order statistic."""
    distances = _beside(counts, nodes, nodes).withColumn("d", F.abs("t"))
    rank = (nearest - 1) / max(total - 1, 1)
    found = quantiles(distances, "d", {"h": rank}, "node", weight="n").collect()  # a row per node
    return [row["h"] for row in sorted(found, key=lambda r: r["node"])]


def _fit(rows: DataFrame, weight: Column, nodes: Sequence[float],
         widths: Sequence[float]) -> list[tuple[float, float | None, int]]:
    """Weighted least-squares line around every node: its value there and the rows behind it.

    Rows are summed per x first. The moments are taken around the node, which keeps them precise;
    one row per node reaches the driver.
    """
    per_x = rows.groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"), F.sum(weight * F.col("y")).alias("wy")
    )
    d, h, t = F.abs("t"), F.col("h"), F.col("t")
    kernel = F.when(d <= 0.001 * h, 1.0).when(d >= 0.999 * h, 0.0).otherwise(
        F.pow(1 - F.pow(F.try_divide(d, h), F.lit(3)), F.lit(3))
    )
    near = _beside(per_x, nodes, widths).withColumn("k", kernel).where("k > 0")
    w, wy = F.col("k") * F.col("w"), F.col("k") * F.col("wy")
    sums = near.groupBy("node").agg(
        F.sum("n").alias("n"), F.sum(w).alias("w"), F.sum(w * t).alias("wt"), F.sum(wy).alias("wy"),
        F.sum(w * t * t).alias("wtt"), F.sum(wy * t).alias("wty"),
    )
    curve = [(at, None, 0) for at in nodes]
    for row in sums.collect():
        w, wt, wy, wtt, wty = (row[c] for c in _SUMS)
        if w > 0:
            mt, my = wt / w, wy / w
            spread = wtt - w * mt * mt
            slope = (wty - w * mt * my) / spread if spread > 1e-12 * wtt else 0.0
            curve[row["node"]] = (nodes[row["node"]], my - slope * mt, row["n"])
    return curve


def _on_curve(nodes: Sequence[float], fitted: Sequence[float | None]) -> Column:
    """The curve at ``x``, linear between the two nodes around it."""
    below = F.size(F.filter(_doubles(nodes), lambda v: v <= F.col("x")))
    above = F.least(below, F.lit(len(nodes) - 1))
    x0, x1 = F.get(_doubles(nodes), below - 1), F.get(_doubles(nodes), above)
    y0, y1 = F.get(_doubles(fitted), below - 1), F.get(_doubles(fitted), above)
    return y0 + (y1 - y0) * F.coalesce(F.try_divide(F.col("x") - x0, x1 - x0), F.lit(0.0))


def local_regression(df: DataFrame, x: str, y: str, frac: float = 2 / 3, iters: int = 3,
                     nodes: int = NODES) -> DataFrame:
    """Smoothed ``y`` at quantiles of ``x``, as a table of (x, fitted, n).

    The definition is the same for every size: at each of the distinct exact quantiles
    ``i / (nodes - 1)`` of x a line is fitted to the ``frac`` of all rows nearest to it, every row
    weighted by the tricube of its own distance; ``n`` counts the rows with a weight. Each
    robustness iteration weighs rows by the bisquare of their residual from the curve (linear
    between nodes) over six median absolute residuals. Rows that lack x or y stay out; without
    any row the result is empty. A node all of whose rows have lost their weight has a NULL value.
    """
    spark = df.sparkSession
    rows = checkpoint(df.select(known(F.col(x)).cast("double").alias("x"), known(F.col(y)).cast("double").alias("y")).dropna())
    counts = checkpoint(rows.groupBy("x").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], _SCHEMA)
    cuts = {f"q{i}": i / max(nodes - 1, 1) for i in range(nodes)}
    places = sorted(set(quantiles(counts, "x", cuts, weight="n").first()))
    widths = _bandwidths(counts, places, max(1, int(frac * total + 1e-10)), total)

    weight = F.lit(1.0)
    for step in range(iters + 1):
        curve = _fit(rows, weight, places, widths)
        if step == iters:
            break
        residual = F.abs(F.col("y") - _on_curve(places, [fitted for _, fitted, _ in curve]))
        scale = 6 * (median(rows.withColumn("r", residual), "r").first() or [0])[0]
        if not scale:
            break
        u = residual / scale
        weight = F.when(u < 1, F.pow(1 - u * u, F.lit(2))).otherwise(0.0)
    return spark.createDataFrame(curve, _SCHEMA)
