"""Token ids in directly addressable codes: any token can be read without decoding a block."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import text_key
from forecourt.llm.encoding import encoder

#: Tokens after which a segment is closed; documents are not parted, so a longer one makes a longer segment.
SEGMENT = 1 << 20
_RANK = 512
_HEAD = struct.Struct("<4sB")
_LEVEL = struct.Struct("<I")


def pack(ids: np.ndarray) -> bytes:
    """Chunk levels of 8 bits: per level the low bytes, a bitmap of the ids that go on, and its ranks.

    Layout, little-endian: ``DAC1``, levels (u8); then for each level its count (u32), the chunk
    bytes, the continuation bitmap (bit ``i % 8`` of byte ``i // 8``) and, for every 512 bits, the
    number of ones before them (u32).
    """
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), _RANK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        ranks = (ones.cumsum() - ones).astype("<u4")
        levels.append(_LEVEL.pack(len(rest)) + rest.astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            return _HEAD.pack(b"DAC1", len(levels)) + b"".join(levels)
        rest = rest[more] >> 8


def _levels(code: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Views of chunks, bitmap and ranks of each level; nothing is copied."""
    mark, count = _HEAD.unpack_from(code)
    if mark != b"DAC1":
        raise ValueError("not a segment of directly addressable codes")
    out, at = [], _HEAD.size
    for _ in range(count):
        (n,) = _LEVEL.unpack_from(code, at)
        sizes = (n, -(-n // 8), -(-n // _RANK) * 4)
        starts = np.cumsum((at + _LEVEL.size, *sizes)).tolist()
        chunks, bits = (np.frombuffer(code, np.uint8, k, p) for k, p in zip(sizes[:2], starts))
        out.append((chunks, bits, np.frombuffer(code, "<u4", sizes[2] // 4, starts[2])))
        at = starts[3]
    return out


def unpack(code: bytes) -> np.ndarray:
    """All ids of a segment."""
    ids = None
    for chunks, bits, _ in reversed(_levels(code)):
        level = chunks.astype(np.uint32)
        if ids is not None:
            level[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= ids << np.uint32(8)
        ids = level
    return ids


def token_at(code: bytes, at: np.ndarray) -> np.ndarray:
    """The ids at the places ``at``: one byte, bit and rank per level, whatever the segment holds."""
    place, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
    alive = np.arange(len(place))
    for depth, (chunks, bits, ranks) in enumerate(_levels(code)):
        out[alive] |= chunks[place].astype(np.uint32) << np.uint32(8 * depth)
        on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        alive, place = alive[on], place[on]
        if not len(alive):
            break
        block, mask = place // _RANK, np.arange(_RANK // 8)
        rows = block[:, None] * (_RANK // 8) + mask
        held = np.where(rows < len(bits), bits[np.minimum(rows, len(bits) - 1)], 0).astype(np.uint8)
        whole = np.bitwise_count(held) * (mask < ((place % _RANK) >> 3)[:, None])
        last = np.bitwise_count(bits[place >> 3] & ((1 << (place & 7)) - 1).astype(np.uint8))
        place = ranks[block].astype(np.int64) + whole.sum(axis=1, dtype=np.int64) + last.astype(np.int64)
    return out


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, kind: str, end_id: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all texts as Parquet files of segments, in ascending order of the id.

    Rows are range-partitioned by id (and text hash, so that one id's rows may be parted), sorted
    and encoded in place; a row of the files is a segment: ``part`` and ``start`` (tokens before it in the part) give its place,
    ``ids`` and ``lengths`` its documents, ``code`` their tokens. Spark commits the files, so a
    task may run twice. Null texts have no ids but the end id; null ids come first; rows with one
    id follow each other by text hash; an empty table writes no segment.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    ordered = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), text_key(text_col).alias("key"))
    ordered = ordered.repartitionByRange("id", "key").sortWithinPartitions("id", "key", "text")
    end = [] if end_id is None else [end_id]

    def run(batches):
        coder = encoder(tokenizer, kind)
        part, start, ids, held, count = 0, 0, [], [], 0

        def segment():
            code = pack(np.concatenate(held) if held else np.zeros(0, np.uint32))
            return pd.DataFrame({
                "part": [part], "start": [start], "ids": [ids], "lengths": [[len(x) for x in held]], "n_tokens": [count], "code": [code],
            })

        for batch in batches:
            if len(batch):
                part = int(batch["part"].iloc[0])
            known = batch["id"].astype(object).where(batch["id"].notna(), None).tolist()
            for name, got in zip(known, coder.encode(batch["text"].tolist())):
                ids.append(name)
                held.append(np.append(got, end).astype(np.uint32))
                count += len(held[-1])
                if count >= SEGMENT:
                    yield segment()
                    start, ids, held, count = start + count, [], [], 0
        if ids:
            yield segment()

    marked = ordered.select("id", "text", F.spark_partition_id().alias("part"))
    marked.mapInPandas(run, f"part int, start bigint, ids array<{id_type}>, lengths array<int>, n_tokens bigint, code binary").write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start`` counted over all parts. The driver sees one sum per part."""
    rows = spark.read.parquet(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, starts = 0, []
    for row in sums:
        starts.append((row["part"], before))
        before += row["n"]
    first = F.broadcast(spark.createDataFrame(starts, "part int, __first bigint"))
    return rows.join(first, "part").withColumn("start", F.col("__first") + F.col("start")).drop("__first")


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, ids)`` of every document, ``ids`` being little-endian 32-bit numbers."""
    rows = segments(spark, path)
    id_type = rows.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in batch.itertuples():
                ids = unpack(row.code).astype("<u4")
                ends = np.cumsum(np.asarray(row.lengths, np.int64))
                begins = ends - row.lengths
                yield pd.DataFrame({
                    "id": pd.Series(list(row.ids), dtype=object), "start": begins + row.start,
                    "ids": [ids[a:b].tobytes() for a, b in zip(begins, ends)],
                })

    found = rows.select("ids", "lengths", "code", "start").mapInPandas(run, f"id {id_type}, start bigint, ids binary")
    return found.withColumnRenamed("id", id_col)


def read_positions(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``(position, token)`` for a table of places in the sequence of all tokens, without decoding.

    Segments and positions meet in windows of ``SEGMENT`` tokens, an equi-join; positions outside
    the sequence have no row.
    """
    rows = segments(spark, path).where("n_tokens > 0")
    window = F.explode(F.sequence(F.floor(F.col("start") / SEGMENT), F.floor((F.col("start") + F.col("n_tokens") - 1) / SEGMENT)))
    spread = rows.select("start", "n_tokens", "code", window.alias("w"))
    wanted = positions.select(F.col("position").cast("bigint").alias("position")).withColumn("w", F.floor(F.col("position") / SEGMENT))
    met = wanted.join(spread, "w").where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))

    def run(batches):
        for batch in batches:
            for start, rows in batch.groupby("start"):
                places = rows["position"].to_numpy(np.int64)
                yield pd.DataFrame({"position": places, "token": token_at(rows["code"].iloc[0], places - start).astype(np.int64)})

    return met.select("position", "start", "code").mapInPandas(run, "position bigint, token bigint")
