"""Packing documents into training sequences by vector best-fit."""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import plain, stored
from forecourt.llm.encoding import encoder

#: Pieces that are packed together; each group leaves at most about one sequence partly empty.
GROUP = 8192


def pieces(
    docs: DataFrame, tokenizer: str, kind: str, capacity: int, end_id: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(uid, id, piece, start, length, ids, ids_crc32)``: every document's ids and its end id.

    Longer documents are cut into pieces of ``capacity``, of which the first may be shorter.
    ``ids`` holds 16-bit numbers if the vocabulary allows, else 32-bit ones; ``ids_crc32`` is the
    checksum of a piece's ids as 32-bit numbers. A null text is an empty one: its end id alone.
    Rows are told apart by ``uid``, so repeated ones all stay; an empty table gives none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = encoder(tokenizer, kind)
        size, end = coder.dtype.itemsize, np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            for at in range(0, len(batch), 2048):
                rows, out = batch.iloc[at : at + 2048], []
                for name, got in zip(rows["id"], coder.encode(rows["text"].tolist())):
                    raw, n = got.tobytes() + end, len(got) + 1
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        piece = raw[a * size : b * size]
                        out.append((name, k, a, b - a, piece, zlib.crc32(np.frombuffer(piece, coder.dtype).astype("<u4"))))
                table = pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids", "ids_crc32"])
                yield table.assign(id=plain(table["id"]))

    chosen = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = chosen.mapInPandas(run, "id string, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint")
    uid = F.monotonically_increasing_id().alias("uid")
    return cut.select(uid, F.col("id").cast(id_type).alias(id_col), "piece", "start", "length", "ids", "ids_crc32")


def best_fit(
    lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], by: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length: the longest first, each into the open bin that suits it best.

    A bin's residual is a vector of tokens, documents and attention cost (the sum of squared
    lengths), in parts of ``capacity``. Among the bins with room in all three, ``norm`` takes the
    least weighted norm of what would be left, ``dot`` the greatest weighted product of demand and
    residual; ties go to the oldest bin. A piece that no bin has room for opens one.
    """
    limit, weight = np.asarray(capacity, float), np.asarray(weights, float)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    shortest = lengths.min(initial=0)
    left = np.zeros((3, max(len(lengths), 1)))  # residuals of the open bins, in the order of opening
    name = np.zeros(left.shape[1], np.int64)
    n = opened = 0
    for step, k in enumerate(order):
        need = np.array([lengths[k], 1, lengths[k] ** 2], float)
        if step % 64 == 0 and n:  # bins that can't take even the shortest are closed
            open_ = np.flatnonzero((left[0, :n] >= shortest) & (left[1, :n] >= 1))
            left[:, : len(open_)], name[: len(open_)], n = left[:, open_], name[open_], len(open_)
        fits = np.flatnonzero(left[0, :n] >= need[0])
        fits = fits[(left[1, fits] >= 1) & (left[2, fits] >= need[2])]
        if len(fits):
            if by == "norm":
                rest = (left[:, fits] - need[:, None]) / limit[:, None]
                best = fits[np.argmin(weight @ (rest * rest))]
            else:
                best = fits[np.argmax((weight * need / limit**2) @ left[:, fits])]
        else:
            best, left[:, n], name[n] = n, limit, opened
            n, opened = n + 1, opened + 1
        bins[k], offsets[k] = name[best], limit[0] - left[0, best]
        left[:, best] -= need
    return bins, offsets


def pack(
    cut: DataFrame, capacity: int, max_docs: int | None = None, max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01), by: str = "norm",
) -> DataFrame:
    """``(uid, sequence_id, offset)`` for stored ``pieces``; only their lengths are shuffled.

    Whole sequences need no packing. The others are dealt by hash into groups of about ``GROUP``
    pieces, each packed in one task with bounded memory. Limits on documents and attention cost
    that are not given are those that the tokens imply. A piece that exceeds the cost alone fails.
    """
    limits = (capacity, max_docs or capacity, max_cost or capacity * capacity)
    full = cut.where(F.col("length") == capacity).select("uid", (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = cut.where(F.col("length") < capacity).select("uid", "length")
    groups = max(1, -(-rest.count() // GROUP))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        lengths = rows["length"].to_numpy(np.int64)
        if (lengths**2).max() > limits[2]:
            raise ValueError("a piece exceeds the attention cost of a sequence")
        bins, offsets = best_fit(lengths, limits, weights, by)
        return pd.DataFrame({"uid": rows["uid"], "sequence_id": (bins * groups + rows["g"].iloc[0]) * 2, "offset": offsets})

    dealt = rest.withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups))).repartition(min(groups, 4096), "g")
    return full.union(dealt.groupBy("g").applyInPandas(run, "uid bigint, sequence_id bigint, offset bigint"))


def pack_documents(
    docs: DataFrame, tokenizer: str, kind: str = "bytes", capacity: int = 2048, end_id: int = 0,
    max_docs: int | None = None, max_cost: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, piece, start, length, ids, ids_crc32, sequence_id, offset)`` per piece; an empty table gives none.

    Whoever selects the checksum and not the ids shuffles no ids.
    """
    cut = stored(pieces(docs, tokenizer, kind, capacity, end_id, id_col, text_col), "pieces")
    placed = stored(pack(cut, capacity, max_docs, max_cost), "places")
    return cut.join(placed, "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, n_docs)``: the tokens of every sequence, at most its capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("p"))
    whole = F.aggregate(F.col("p"), F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return joined.select("sequence_id", whole.alias("ids"), F.size("p").alias("n_docs"))
