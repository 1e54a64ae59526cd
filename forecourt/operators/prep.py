"""Scaling, encoding and splitting, fitted on one table and applied to any other."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, IntegerType, LongType, StructField, StructType

from forecourt import vocabulary as V
from forecourt.functions.numeric import long_form
from forecourt.operators.lookup import BROADCAST_ROWS, lookup_join
from forecourt.operators.quantiles import quantiles
from forecourt.session import stored


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations; a constant column is only centred."""

    means: dict[str, float]
    deviations: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "Scaler":
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in cols],
        ).first()
        return cls(
            {c: row[f"m_{c}"] or 0.0 for c in cols}, {c: row[f"s_{c}"] or 1.0 for c in cols}
        )

    def scaled(self, col: str, source: Column | None = None) -> Column:
        source = F.col(col) if source is None else source
        return (source.cast("double") - F.lit(self.means[col])) / F.lit(self.deviations[col])

    def transform(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": self.scaled(c) for c in self.means})


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return Scaler.fit(df, cols).transform(df)


def _indexer(cols: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}_index" for c in cols],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )


def _codes(model) -> list[str]:
    """SQL giving each category's rank, -1 if unseen; plain numbers, so no nominal metadata."""
    return [
        f"CASE WHEN {c}_index = {len(labels)} THEN -1D ELSE {c}_index + 0D END AS {c}_code"
        for c, labels in zip(model.getInputCols(), model.labelsArray)
    ]


def category_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code): the rank of every distinct value of each column, from 0, in binary order of the text.

    Distinct values are range-partitioned and numbered within their partition, from the number of
    values that the partitions before hold. No list of values is gathered anywhere.
    """
    distinct = long_form(df, list(cols)).where(F.col("value").isNotNull()).distinct()
    parts = distinct.repartitionByRange("column", "value").withColumn("_part", F.spark_partition_id())
    values = stored(parts, "categories")
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        values.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    place = F.row_number().over(Window.partitionBy("column", "_part").orderBy("value"))
    code = (F.col("_offset") + place - 1).cast("double").alias("code")
    return lookup_join(values, offsets, ["column", "_part"], "inner").select("column", "value", code)


def ordinal_encode(df: DataFrame, cols: Sequence[str], fitted_on: DataFrame | None = None, few: int = BROADCAST_ROWS // 2) -> DataFrame:
    """Adds ``<col>_code``: the rank of the category among those of ``fitted_on``; -1 if missing or unseen there.

    Codes are joined back, by broadcast only where they are few. Where ``df`` codes itself, the rows of a column of
    more than about ``few`` values are ranked where they lie, see :func:`_ranked`, so that nothing of its size is joined.
    """
    wide: list[str] = []
    if fitted_on is None:
        counts = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")) for c in cols]).first()
        wide = [c for c, n in zip(cols, counts) if n > few]
    out, joined_back = df, [c for c in cols if c not in wide]
    for c in wide:
        out = _ranked(out, c)
    if joined_back:
        codes = stored(category_codes(df if fitted_on is None else fitted_on, joined_back), "codes")
    for c in joined_back:
        mine = codes.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = lookup_join(out.withColumn("_value", F.col(c).cast("string")), mine, "_value")
        out = joined.withColumn(f"{c}_code", F.coalesce("_code", F.lit(-1.0))).drop("_value", "_code")
    return out.select(*df.columns, *[f"{c}_code" for c in cols])


def _ranked(df: DataFrame, col: str) -> DataFrame:
    """Adds ``<col>_code`` as :func:`category_codes` numbers the values, by one shuffle of the rows and one stored copy.

    Rows are range-partitioned by value, and those of one value by their other columns, so that a frequent value has
    several parts. A scan in order counts the values of each part; the parts' first and last values tell
    which of them go on with the value before.
    """
    value = F.col(col).cast("string")
    plain = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    rows = df.repartitionByRange(value, F.xxhash64(*plain)).select("*", value.alias("_value"), F.spark_partition_id().alias("_part"))

    def counted(batches):
        last, place = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(len(names))
            before = pa.concat_arrays([pa.array([last], values.type), values.slice(0, len(values) - 1)])
            new = pc.and_kleene(pc.is_valid(values), pc.fill_null(pc.not_equal(values, before), True)).to_numpy(zero_copy_only=False)
            places = place + np.cumsum(new)
            last, place = values[-1].as_py(), int(places[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], batch.column(len(names) + 1), pa.array(places, pa.int64())], [*names, "_part", "_place"])

    names, fields = df.columns, [*df.schema.fields, StructField("_part", IntegerType()), StructField("_place", LongType())]
    kept = stored(rows.sortWithinPartitions("_value").mapInArrow(counted, StructType(fields)), "ranks")
    parts = kept.where(value.isNotNull()).groupBy("_part").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.max("_place").alias("n"))
    offsets, offset, last = [], 0, None
    for r in parts.orderBy("_part").toLocalIterator():
        offset -= r["first"] == last
        offsets.append((r["_part"], offset))
        offset, last = offset + r["n"], r["last"]
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset bigint")
    code = F.when(value.isNotNull(), (F.col("_offset") + F.col("_place") - 1).cast("double")).otherwise(-1.0)
    return lookup_join(kept, table, "_part").withColumn(f"{col}_code", code).select(*names, f"{col}_code")


def fit_preprocessor(train: DataFrame, task: str = "regression") -> PipelineModel:
    """Scaled numbers and category codes as one vector ``features``; persistable."""
    numeric, categorical = V.feature_columns(task)
    scaler = Scaler.fit(train, numeric)
    indexer = _indexer(categorical).fit(train)
    scaled = [
        f"(CAST({c} AS DOUBLE) - ({scaler.means[c]!r}D)) / ({scaler.deviations[c]!r}D) AS {c}_z"
        for c in numeric
    ]
    encode = SQLTransformer(
        statement=f"SELECT *, {', '.join([*scaled, *_codes(indexer)])} FROM __THIS__"
    )
    assemble = VectorAssembler(
        inputCols=[f"{c}_z" for c in numeric] + [f"{c}_code" for c in categorical],
        outputCol="features",
    )
    return PipelineModel(stages=[indexer, encode, assemble])


def feature_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``features`` of a fitted preprocessor as an array of doubles, by its stages but the assembling one.

    Models read an array as they read a vector. Unlike a vector it needs no conversion of every row
    in every scan. A missing feature is an error, as it is for the assembler.
    """
    cols = model.stages[-1].getInputCols()
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    values = F.when(known, F.array(*cols)).otherwise(F.raise_error(F.lit("a feature is null or NaN")))
    return PipelineModel(stages=model.stages[:-1]).transform(df).select(*df.columns, values.alias("features"))


def hash_share(seed: int, key: str = "listing_id") -> Column:
    """A number in [0, 1) fixed by seed and key, whatever the partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def split(df: DataFrame, test_share: float = 0.2, seed: int = 42,
          key: str = "listing_id") -> tuple[DataFrame, DataFrame]:
    """Train and test rows; no shuffle, and a row always falls on the same side."""
    share = hash_share(seed, key)
    return df.where(share < 1 - test_share), df.where(share >= 1 - test_share)


def stratified_split(df: DataFrame, by: str, test_share: float = 0.2, seed: int = 42,
                     key: str = "listing_id") -> tuple[DataFrame, DataFrame]:
    """As :func:`split` with the shares held in every class to within one row.

    The border in each class is the exact quantile of its hash values, so that no class is
    sorted or gathered. The marked rows are written once to the shared folder; both sides read them from there.
    Rows without a class are on neither side.
    """
    rows = df.withColumn("_share", hash_share(seed, key))
    borders = quantiles(rows, "_share", {"_border": 1 - test_share}, by)
    marked = lookup_join(rows, borders, by, "inner")
    sides = stored(marked.withColumn("_is_test", F.col("_share") > F.col("_border")).drop("_share", "_border"), "split")
    return sides.where(~F.col("_is_test")).drop("_is_test"), sides.where("_is_test").drop("_is_test")


def fold(k: int, seed: int = 7, key: str = "listing_id") -> Column:
    return F.floor(hash_share(seed, key) * k).cast("int")
