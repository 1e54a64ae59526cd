"""SimHash near-duplicates, linked by a tiled exact comparison of all fingerprints."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import plain, stored, text_key, words
from forecourt.llm.components import stars

SEED = 42
#: Fingerprints in a tile, at least and at most: 0.5 to 2 MB.
TILE = (1 << 16, 1 << 18)
_BLOCK = 1 << 20
#: Tasks that compare pairs of tiles, at most; each takes its pairs one after another.
_TASKS = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included, as a signed number."""
    parts = words(text, lower=True)
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(parts))
    spans = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(parts) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, key, bits)`` per row, ``key`` being a hash of the text; a wordless text has fingerprint zero."""

    def run(batches):
        for batch in batches:
            bits = [fingerprint(t, shingle) for t in batch["text"]]
            yield pd.DataFrame({"id": plain(batch["id"]), "key": batch["key"], "bits": bits})

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(
        F.col(id_col).cast("string").alias("id"), text_key(text_col).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    marked = chosen.mapInPandas(run, "id string, key bigint, bits bigint")
    return marked.select(F.col("id").cast(kind).alias(id_col), "key", "bits")


def _forest(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of ``i`` and ``j`` pairwise; every root is the smallest of its tree."""

    def root(x):
        x = parent[x]
        while (up := parent[x]) is not x and (up != x).any():
            x = up
        return x

    while True:
        a, b = root(i), root(j)
        apart = a != b
        if not apart.any():
            parent[i], parent[j] = a, b
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _cells(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the population counts of the four 16-bit quarters: sorted bits, counts and starts of cells."""
    counts = np.bitwise_count(bits.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    key = counts.astype(np.int64) @ np.array([17**3, 17**2, 17, 1])
    order = np.argsort(key, kind="stable")
    _, starts = np.unique(key[order], return_index=True)
    return bits[order], counts[order[starts]], np.append(starts, len(bits))


def compare_tiles(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of two tiles, or within one, as a spanning forest: at most one link per fingerprint.

    Two fingerprints differ in at least as many bits as the counts of their quarters do, so cells
    of equal counts are compared only with cells within the radius; those by exclusive-or and bit
    counts, in blocks of bounded size.
    """
    a, a_counts, a_starts = _cells(left)
    b, b_counts, b_starts = (a, a_counts, a_starts) if right is None else _cells(right)
    shift = 0 if right is None else len(a)
    cell_of = np.repeat(np.arange(len(b_counts)), np.diff(b_starts))
    parent = np.arange(len(a) + (len(b) if shift else 0))
    for c in range(len(a_counts)):
        near = np.abs(b_counts - a_counts[c]).sum(axis=1) <= radius
        if right is None:
            near[:c] = False
        if not near.any():
            continue
        rows = np.flatnonzero(near[cell_of])
        other, step = b[rows], max(1, _BLOCK // len(rows))
        for at in range(a_starts[c], a_starts[c + 1], step):
            mine = a[at : min(at + step, a_starts[c + 1]), None]
            i, j = np.nonzero(np.bitwise_count(mine ^ other) <= radius)
            if len(i):
                _forest(parent, i + at, rows[j] + shift)
    everything = np.concatenate((a, b)) if shift else a
    _forest(parent, np.arange(len(parent)), parent.copy())
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    return everything[linked].view(np.int64), everything[parent[linked]].view(np.int64)


def _blocks(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int]]:
    """``(lowest, highest, first tile, tiles)`` for ranges of population counts, in order: at most 65.

    Neighbouring counts share a tile while it has room; a count too large for one tile has several.
    """
    blocks: list[tuple[int, int, int, int]] = []
    held = 0
    for n in sorted(counts):
        have = counts[n]
        if blocks and blocks[-1][3] == 1 and held + have <= size:
            low, _, first, _ = blocks[-1]
            blocks[-1], held = (low, n, first, 1), held + have
        else:
            first = blocks[-1][2] + blocks[-1][3] if blocks else 0
            blocks, held = [*blocks, (n, n, first, max(1, -(-have // size)))], have
    return blocks


def link(bits: DataFrame, radius: int = 3, tile: tuple[int, int] = TILE) -> DataFrame:
    """Links ``(a, b)`` that connect all of the distinct ``bits`` within ``radius``, transitively.

    Tiles are ranges of the population count, classes too large for one tile are split by hash.
    Only pairs of tiles whose counts lie within the radius meet, one pair per task row. The driver
    sees 65 counts and pairs of ranges of them; Spark lists the pairs of tiles. The comparisons still grow with
    the square of the distinct fingerprints.
    """
    spark = bits.sparkSession
    counts = dict(bits.groupBy(F.bit_count("bits").alias("n")).count().collect())
    size = min(max(sum(counts.values()) // 128, tile[0]), tile[1])
    blocks = _blocks(counts, size)
    first, split = [0] * 65, [1] * 65
    for low, high, at, n in blocks:
        first[low : high + 1], split[low : high + 1] = [at] * (high - low + 1), [n] * (high - low + 1)
    near = [(p, q) for i, p in enumerate(blocks) for q in blocks[i:] if q[0] - p[1] <= radius]
    n_pairs = sum(p[3] * (p[3] + 1) // 2 if p == q else p[3] * q[3] for p, q in near)

    lookup = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.bit_count("bits") + 1)
    own = lookup(first) + F.pmod(F.xxhash64("bits"), lookup(split)).cast("int")
    tiles = bits.withColumn("tile", own).groupBy("tile").agg(F.collect_list("bits").alias("bits"))
    ranges = spark.createDataFrame([(p[2], p[2] + p[3] - 1, q[2], q[2] + q[3] - 1) for p, q in near], "a int, b int, c int, d int")
    rows = ranges.select(F.explode(F.sequence("a", "b")).alias("x"), "c", "d").repartition("x")
    pairs = rows.select("x", F.explode(F.sequence(F.greatest("x", "c"), "d")).alias("y"))
    sides = pairs.select(F.concat_ws("-", "x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("tile"))
    meeting = sides.join(tiles, "tile").select("tile", "bits", "pair")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        sides = [np.asarray(x, np.int64).view(np.uint64) for x in rows.sort_values("tile")["bits"]]
        x, y = rows["pair"].iloc[0].split("-")
        if x != y and len(sides) < 2:  # the other tile is empty
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = compare_tiles(sides[0], sides[1] if x != y else None, radius)
        return pd.DataFrame({"a": a, "b": b})

    # A fixed number of tasks: adaptive execution would merge pairs, which are few bytes but much work.
    tasks = max(1, min(n_pairs, _TASKS))
    return meeting.repartition(tasks, "pair").groupBy("pair").applyInPandas(compare, "a bigint, b bigint")


def clusters(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
) -> DataFrame:
    """``(id, key, bits, root, component)`` per row, the component being the smallest id reachable.

    ``root`` is the fingerprint that stands for the component. Repeated rows, and rows of one id
    with several texts, are linked by their fingerprints like any others. A null id takes part in
    links; a component of nulls only has a null name. An empty table gives an empty result.
    Columns besides the two named are not read.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(marked.groupBy("bits").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    roots = stars(link(nodes.select("bits"), radius))
    rooted = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = rooted.join(named, "root").select("bits", "root", "component")
    return marked.join(found, "bits").select(id_col, "key", "bits", "root", "component")


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, then of the smallest text hash."""
    found = stored(clusters(docs, id_col, text_col, shingle, radius), "clusters")
    first = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).alias("id"), "key")).alias("m"))
    first = first.select(F.col("m.id").alias("__id"), F.col("m.key").alias("__key"))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (text_key(text_col) == F.col("__key"))
    kept = docs.join(first, same, "left_semi")
    if found.groupBy(id_col, "key").count().where("count > 1").isEmpty():
        return kept
    each = Window.partitionBy(id_col, text_key(text_col)).orderBy(F.lit(0))
    return kept.withColumn("__n", F.row_number().over(each)).where("__n = 1").drop("__n")
