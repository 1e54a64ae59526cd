"""Token counts that follow edits: a segment tree over the pre-tokens of every document."""

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import plain, stored, text_key
from forecourt.llm.encoding import encoder

#: Pre-tokens in a leaf.
LEAF = 64
#: How byte-level BPE cuts a text before merging. Fixed by the vocabulary.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def leaves(text: str, counts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the leaves in characters, and their tokens."""
    if not len(counts):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    starts = np.arange(0, len(counts), LEAF)
    return np.add.reduceat(lengths, starts).cumsum().astype(np.int32), np.add.reduceat(counts, starts).astype(np.int32)


def tree(leaf_counts: np.ndarray) -> np.ndarray:
    """Subtree sums as a heap: node ``k`` has the children ``2k`` and ``2k + 1``, the root is 1."""
    width = 1 << max(0, len(leaf_counts) - 1).bit_length()
    out = np.zeros(2 * width, np.int32)
    out[width : width + len(leaf_counts)] = leaf_counts
    while width > 1:
        below, width = out[width : 2 * width], width // 2
        out[width : 2 * width] = below[::2] + below[1::2]
    return out


def set_leaf(heap: np.ndarray, leaf: int, count: int) -> None:
    """Give a leaf another count and correct the sums on the way to the root."""
    node = len(heap) // 2 + leaf
    change = count - heap[node]
    while node and change:
        heap[node] += change
        node //= 2


def count_trees(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None,
) -> DataFrame:
    """``(id, key, n_tokens, ends, sums, marked)``: the count of every text with its tree.

    ``ends`` (character offsets of the leaves) and ``sums`` (the heap) are little-endian 32-bit
    arrays. A null or empty text has no leaf and no token. Special tokens' strings are ordinary
    text. The tokenizer is byte-level, so counts of pre-tokens add up. ``marked`` says where the
    condition ``mark`` holds, so that those trees can be taken without looking for them. Repeated
    rows and rows without an id have a row each; an empty table gives none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = encoder(tokenizer, "bytes", ordinary=True)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                rows = batch.iloc[at : at + 1024]
                cut = [PRE_TOKEN.findall(t or "") for t in rows["text"]]
                found = []
                for text, parts, counts in zip(rows["text"], cut, coder.count(cut)):
                    ends, sums = leaves(text or "", counts, np.fromiter(map(len, parts), np.int64, len(parts)))
                    found.append((int(sums.sum()), ends.tobytes(), tree(sums).tobytes()))
                out = pd.DataFrame(found, columns=["n_tokens", "ends", "sums"])
                yield out.assign(id=plain(rows["id"]), key=rows["key"].to_numpy(), marked=rows["marked"].to_numpy())

    marked = F.coalesce(F.lit(False) if mark is None else mark, F.lit(False)).alias("marked")
    text = F.col(text_col).cast("string").alias("text")
    chosen = docs.select(F.col(id_col).cast("string").alias("id"), text_key(text_col).alias("key"), text, marked)
    made = chosen.mapInPandas(run, "id string, key bigint, n_tokens bigint, ends binary, sums binary, marked boolean")
    return made.select(F.col("id").cast(id_type).alias(id_col), "key", "n_tokens", "ends", "sums", "marked")


def recount(
    text: str, ends: np.ndarray, heap: np.ndarray, edits: list[tuple[int, int, str]], count,
) -> tuple[str, np.ndarray, np.ndarray, int]:
    """The edited text, its leaf ends, its tree with corrected sums, and the characters encoded again.

    ``count`` gives the tokens of a list of pre-tokens. ``edits`` are ``(start, end, replacement)`` in characters of the old text, sorted and apart.
    Cutting restarts at the leaf before the one that an edit touches, so that the last pre-token
    before it may grow, and goes on behind it until a cut falls on the end of an old leaf, with
    another untouched leaf before the next edit. From there on the old cuts hold, as a cut depends
    on nothing before it. The leaves of such a region become one, the rest of them empty; all
    others keep their counts.
    """
    if not len(ends):
        new = "".join(x for _, _, x in edits) + text
        return new, np.array([len(new)], np.int32), np.array([0, count(PRE_TOKEN.findall(new))], np.int32), len(new)
    heap, new_ends = heap.copy(), ends.astype(np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    n, k, encoded, done, out = len(ends), 0, 0, 0, []  # the new text is out + text[done:]

    def beyond(leaf: int, step: int) -> int:
        """The next leaf that holds something."""
        leaf += step
        while 0 < leaf < n - 1 and starts[leaf] == ends[leaf]:
            leaf += step
        return min(max(leaf, 0), n - 1)

    while k < len(edits):
        leaf = beyond(int(np.searchsorted(ends, edits[k][0], "left")), -1)
        at, changed, last = int(starts[leaf]), [], leaf
        begin = at
        while True:
            while k < len(edits) and edits[k][0] <= int(ends[beyond(last, 1)]):
                changed += [text[at : edits[k][0]], edits[k][2]]
                at = edits[k][1]
                k += 1
                while int(ends[last]) < at:
                    last += 1
            stop = int(ends[last])
            region = "".join(changed) + text[at:stop]
            parts = _cut(region, text[stop : stop + 64])
            if parts is not None:
                break
            last += 1
        out += [text[done:begin], region]
        encoded += len(region)
        set_leaf(heap, leaf, count(parts))
        for other in range(leaf + 1, last + 1):
            set_leaf(heap, other, 0)
        moved = sum(map(len, out)) - stop
        new_ends[leaf : last + 1] = sum(map(len, out))
        new_ends[last + 1 :] = ends[last + 1 :] + moved
        done = stop
    return "".join(out) + text[done:], new_ends.astype(np.int32), heap, encoded


def _cut(region: str, behind: str) -> list[str] | None:
    """The pre-tokens of ``region`` before ``behind``, the beginning of what follows; None if one spans both."""
    at, parts = 0, []
    for found in PRE_TOKEN.finditer(region + behind):
        if at >= len(region):
            break
        parts.append(found.group())
        at = found.end()
    return parts if at == len(region) else None


def _same(id_col: str) -> Column:
    """Equal ids, null or not, and equal texts."""
    return F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, key, text, n_tokens, ends, sums, n_edits, n_encoded)`` of the documents that ``edits`` names.

    ``edits`` has ``(id, key, text, edits)``: a document's old text and an array of ``(start, end,
    text)`` in its characters, sorted and not overlapping. Both tables are shuffled, so ``trees``
    should hold little more than the edited ones. Documents without edits have no row; their
    trees hold as they are. Repeated rows have one row together; ids may be null.
    """
    id_type = trees.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = encoder(tokenizer, "bytes", ordinary=True)
        count = lambda parts: int(coder.count([parts])[0].sum())
        for batch in batches:
            found = []
            for row in batch.itertuples():
                changes = [(x["start"], x["end"], x["text"] or "") for x in row.edits]
                ends, heap = np.frombuffer(row.ends, np.int32), np.frombuffer(row.sums, np.int32)
                new, ends, heap, encoded = recount(row.text or "", ends, heap, changes, count)
                found.append((row.id, row.key, new, int(heap[1]), ends.tobytes(), heap.tobytes(), len(changes), encoded))
            yield pd.DataFrame(found, columns=["id", "key", "text", "n_tokens", "ends", "sums", "n_edits", "n_encoded"])

    shapes = trees.select(F.col(id_col).alias("__id"), F.col("key").alias("__key"), "ends", "sums")
    wanted = edits.join(shapes, _same(id_col)).dropDuplicates([id_col, "key"])
    made = wanted.select(F.col(id_col).cast("string").alias("id"), "key", "text", "ends", "sums", "edits").mapInPandas(
        run, "id string, key bigint, text string, n_tokens bigint, ends binary, sums binary, n_edits int, n_encoded bigint"
    )
    return made.withColumn(id_col, F.col("id").cast(id_type)).drop(*(["id"] if id_col != "id" else []))


def masks(docs: DataFrame, pattern: str, replacement: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Edits that replace every match of ``pattern``: ``(id, key, text, edits)`` of the documents with one.

    Repeated rows have one row together; null and empty texts and an empty table have none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        search = regex.compile(pattern)
        for batch in batches:
            found = []
            for row in batch.itertuples():
                edits = [(m.start(), m.end(), replacement) for m in search.finditer(row.text)]
                if edits:
                    found.append((row.id, row.key, row.text, [{"start": a, "end": b, "text": t} for a, b, t in edits]))
            yield pd.DataFrame(found, columns=["id", "key", "text", "edits"])

    some = docs.where(F.col(text_col).rlike(pattern)).select(F.col(id_col).cast("string").alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    made = some.mapInPandas(run, "id string, key bigint, text string, edits array<struct<start int, end int, text string>>")
    return made.select(F.col("id").cast(id_type).alias(id_col), "key", "text", "edits").dropDuplicates([id_col, "key"])


def counts_after(docs: DataFrame, tokenizer: str, pattern: str, replacement: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_edits, n_tokens_after, n_encoded)`` per row, before and after masking ``pattern``.

    ``n_encoded`` is the number of characters that were encoded again. Rows without an id
    are edited as all others: edits are found by id, null or not, and text; equal rows have equal
    results. Null and empty texts count nothing, an empty table gives no rows. Texts and trees of
    documents without a match are not shuffled.
    """
    trees = stored(count_trees(docs, tokenizer, id_col, text_col, F.col(text_col).rlike(pattern)), "count-trees")
    edits = masks(docs, pattern, replacement, id_col, text_col)
    after = apply_edits(trees.where("marked").dropDuplicates([id_col, "key"]), edits, tokenizer, id_col).select(
        F.col(id_col).alias("__id"), F.col("key").alias("__key"), F.col("n_tokens").alias("__after"), "n_edits", "n_encoded"
    )
    both = trees.select(id_col, "key", "n_tokens").join(after, _same(id_col), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return both.select(id_col, "n_tokens", zero("n_edits"), F.coalesce("__after", "n_tokens").alias("n_tokens_after"), zero("n_encoded"))
