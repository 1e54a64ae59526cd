"""Pearson correlations of many column pairs.

Columns without gaps go through Spark ML's Gram matrix, one centred pass for all pairs:
dozens of separate correlation aggregates outgrow generated code. Pairs with gaps are
complete-case each and get their own sums.
"""

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import known

_PAIRS_PER_SCAN = 20


def _with_gaps(x: str, y: str) -> Column:
    """NULL for a constant column (the built-in raises under ANSI)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.when(
        (F.min(a) < F.max(a)) & (F.min(b) < F.max(b)),
        F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)),
    )


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Long form of the given ordered pairs; a pair and its mirror share one computation."""
    columns = sorted({c for pair in pairs for c in pair})
    unordered = sorted({tuple(sorted(pair)) for pair in pairs})
    # Read several times below, and only these columns.
    values = df.select(*[known(F.col(c)).alias(c) for c in columns]).persist(StorageLevel.MEMORY_AND_DISK)
    seen = values.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
          for c in columns],
    ).first()
    varying = [c for c in columns if seen[c]["n"] and seen[c]["low"] < seen[c]["high"]]
    complete = [c for c in varying if seen[c]["n"] == seen["_rows"]]

    found: dict[tuple[str, str], float | None] = {}
    if complete:
        vectors = VectorAssembler(inputCols=complete, outputCol="v").transform(values.select(*complete))
        matrix = Correlation.corr(vectors.select("v"), "v").first()[0].toArray()
        for i, x in enumerate(complete):
            for j, y in enumerate(complete):
                found[x, y] = float(matrix[i, j])
    gapped = [p for p in unordered if p not in found and set(p) <= set(varying)]
    for start in range(0, len(gapped), _PAIRS_PER_SCAN):
        some = gapped[start:start + _PAIRS_PER_SCAN]
        found |= dict(zip(some, values.agg(*[_with_gaps(x, y) for x, y in some]).first()))

    values.unpersist()
    rows = [(x, y, found.get(tuple(sorted((x, y))))) for x, y in pairs]
    return df.sparkSession.createDataFrame(rows, "x string, y string, correlation double")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All ordered pairs in long form."""
    return _pairs(df, [(x, y) for x in cols for y in cols])


def correlation_with_target(df: DataFrame, cols: Sequence[str], target: str = "price") -> DataFrame:
    """Correlation of each column with the target, weakest (most negative) first."""
    return (
        _pairs(df, [(c, target) for c in cols if c != target])
        .select(F.col("x").alias("column"), "correlation")
        .orderBy("correlation", "column")
    )
