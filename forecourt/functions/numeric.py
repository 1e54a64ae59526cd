"""Small numeric helpers shared by the operators."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at_least(c: Column, bound: float) -> Column:
    """Clip from below; NULL stays NULL (``greatest`` would return the bound)."""
    return F.when(c < bound, F.lit(bound)).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * ratio(part, whole)


def known(c: Column) -> Column:
    """NaN counts as missing everywhere, as NULL does."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def feature_values(df: DataFrame, col: str = "features") -> Column:
    """Features as an array of doubles, whether ``df`` holds them as one or as a vector."""
    return F.col(col) if isinstance(df.schema[col].dataType, T.ArrayType) else vector_to_array(col)


def scalar_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct-valued scalar subquery.

    Spark evaluates it once and inlines the values, so no join is planned.
    """
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row")).scalar()


def flag(predicate: Column) -> Column:
    """0/1 indicator; an unknown predicate is 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def long_form(df: DataFrame, columns: list[str], name: str = "column",
              value: str = "value", cast: str = "string", keep=()) -> DataFrame:
    """One row per (row, column): a projection, no shuffle."""
    return df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(
        list(keep), columns, name, value
    )


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back: the array-library rule."""
    scale = 10.0**digits
    return F.rint(c * scale) / scale
