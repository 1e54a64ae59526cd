"""Shards of equal bytes: sampled splitters, range partitions, overfull ranges cut again."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import stored, text_key

#: Ranges per shard at least, and the bytes that a range should hold at most.
RANGES_PER_SHARD, RANGE_BYTES = 16, 32 << 20
#: Samples per range; with them a range of twice the aim is rare.
SAMPLES = 24
_ROUNDS = 8
#: The order of the records: hash of the text, then id.
KEY = ["__h", "__i"]


def record_size(text_col: str = "text") -> F.Column:
    """UTF-8 bytes and one for the end; a null text has none."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + 1


def _sample(rows: DataFrame, rate: float) -> pd.DataFrame:
    """Rows drawn with a probability of their size times ``rate``, by a hash, so that retries agree.

    The expected number is total size times rate; the caller bounds it.
    """
    draw = F.pmod(F.xxhash64(F.lit(7), *KEY), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(draw < F.col("__size") * rate).select(*KEY, "__size").toPandas()


def _splitters(sample: pd.DataFrame, rate: float, parts: int) -> pd.DataFrame:
    """Quantiles of the sample as upper bounds; a record larger than a draw's worth weighs its size."""
    if sample.empty or parts < 2:
        return sample.head(0)[KEY]
    ordered = sample.sort_values(KEY)
    weight = np.maximum(ordered["__size"].to_numpy() * rate, 1.0).cumsum()
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return ordered.iloc[np.unique(at)][KEY].drop_duplicates()


def _range_of(h: np.ndarray, i: np.ndarray, bounds_h: np.ndarray, bounds_i: np.ndarray) -> np.ndarray:
    """Number of bounds below the key ``(h, i)``, vectorised; bounds are sorted."""
    low, high = np.searchsorted(bounds_h, h, "left"), np.searchsorted(bounds_h, h, "right")
    out = low.copy()
    for value in np.unique(bounds_h[low[high > low]]):  # keys that share their hash with a bound
        a, b = np.searchsorted(bounds_h, value, "left"), np.searchsorted(bounds_h, value, "right")
        mine = h == value
        out[mine] = a + np.searchsorted(bounds_i[a:b], i[mine], "left")
    return out


def _sorted(bounds: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    ordered = bounds.sort_values(KEY)
    return ordered["__h"].to_numpy(np.int64), ordered["__i"].to_numpy(np.int64)


def _ranged(rows: DataFrame, bounds: pd.DataFrame) -> DataFrame:
    """``rows`` with the number of their range. The bounds are one for every ``RANGE_BYTES`` of input."""
    shared = rows.sparkSession.sparkContext.broadcast(_sorted(bounds))

    @F.pandas_udf("int")
    def number(h: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series(_range_of(h.to_numpy(np.int64), i.to_numpy(np.int64), *shared.value))

    return rows.withColumn("__range", number(*KEY))


def _only(rows: DataFrame, ranges: pd.Series) -> DataFrame:
    return rows.where(F.col("__range").isin([int(x) for x in ranges]))


def _sums(rows: DataFrame) -> pd.DataFrame:
    key = F.struct(*KEY)
    return rows.groupBy("__range").agg(
        F.sum("__size").alias("bytes"), F.count("*").alias("rows"), (F.min(key) != F.max(key)).alias("many")
    ).orderBy("__range").toPandas()


def _bounds(keys: DataFrame, total: int, parts: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Splitters and the sums of their ranges; overfull ranges are sampled again and cut."""
    rate, aim = SAMPLES * parts / max(total, 1), 2 * total / parts
    bounds = _splitters(_sample(keys, rate), rate, parts)
    sums = _sums(_ranged(keys, bounds))
    for _ in range(_ROUNDS):
        full = sums[(sums["bytes"] > aim) & sums["many"]]
        if full.empty:
            break
        share = 4 * SAMPLES * len(full) / float(full["bytes"].sum())
        drawn = _sample(_only(_ranged(keys, bounds), full["__range"]), share)
        at = _range_of(drawn["__h"].to_numpy(np.int64), drawn["__i"].to_numpy(np.int64), *_sorted(bounds))
        more = [_splitters(drawn[at == r], share, int(2 * size // aim) + 1) for r, size in zip(full["__range"], full["bytes"])]
        grown = pd.concat([bounds, *more]).drop_duplicates()
        if len(grown) == len(bounds):
            break
        bounds, sums = grown, _sums(_ranged(keys, grown))
    return bounds, sums


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: shards of nearly equal bytes, slots gapless from 0.

    Records are ordered by a hash of their text and then by id, so equal texts lie next to each
    other, and a hot group of them is cut by id like any range. Splitters are quantiles of a
    size-weighted sample; ranges that hold more than twice their aim get splitters of their own,
    until none is left that can be cut. Exact sums per range then give every range its place in
    the sequence of all bytes, and a running sum within the range gives every record its own, so
    a shard misses its share by less than two records. Nothing but one number per range
    reaches the driver: one range for every 32 MB.

    Ids are integers. Null ids sort first and count as any other; a null text has the size 1, as
    an empty one. Rows equal in id and text share a range. Other columns pass through, but for
    ``shard`` and ``slot``, which are replaced; an empty table gives an empty result.
    """
    keyed = docs.withColumns({
        "__h": text_key(text_col), "__i": F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))),
        "__size": record_size(text_col),
    })
    keys = stored(keyed.select(*KEY, "__size"), "shard-keys")
    total, largest = (x or 0 for x in keys.agg(F.sum("__size"), F.max("__size")).first())
    bounds, sums = _bounds(keys, total, max(RANGES_PER_SHARD * shards, -(-total // RANGE_BYTES)))

    spark = docs.sparkSession
    sums["before"] = sums["bytes"].cumsum() - sums["bytes"]
    table = pd.DataFrame({
        "__range": sums["__range"].astype("int32"), "__bytes": sums["before"].astype("int64"),
        "__rows": (sums["rows"].cumsum() - sums["rows"]).astype("int64"),
    })
    starts = F.broadcast(spark.createDataFrame(table, "__range int, __bytes bigint, __rows bigint"))
    order = Window.partitionBy("__range").orderBy(*KEY)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def placed(rows: DataFrame) -> DataFrame:
        row = rows.join(starts, "__range").withColumns({
            "__at": F.col("__bytes") + F.sum("__size").over(running) - F.col("__size"),
            "__row": F.col("__rows") + F.row_number().over(order) - 1,
        })
        share = F.expr(f"cast((__at + __size div 2) * {shards} div {max(total, 1)} as int)")
        return row.withColumn("shard", share)

    # The first row of a shard lies in a range that spans a border; only those are looked at for it.
    edges = np.array([total * k // shards for k in range(shards)])
    spans = [bool(((a - largest <= edges) & (edges <= a + b + largest)).any()) for a, b in zip(sums["before"], sums["bytes"])]
    border = placed(_only(_ranged(keys, bounds), sums["__range"][spans]))
    firsts = border.groupBy("shard").agg(F.min("__row").alias("__first")).collect()
    firsts = F.broadcast(spark.createDataFrame(firsts, "shard int, __first bigint"))
    others = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = placed(_ranged(keyed.drop("shard", "slot"), bounds)).join(firsts, "shard")
    return whole.select(*[F.col(f"`{c}`") for c in others], "shard", (F.col("__row") - F.col("__first")).alias("slot"))
