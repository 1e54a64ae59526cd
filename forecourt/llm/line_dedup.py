"""Lines repeated across documents, found by sorted hashes; DataFrame functions only."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import SPACE, stored, text_key

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Into how many parts the documents of one key are dealt, so that a common line is no single group.
SALTS = 32
_WORD = 64


def split_lines(text: str = "text") -> F.Column:
    """Lines of a whole text; a null or empty one has one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: str) -> F.Column:
    return F.translate(F.btrim(F.col(line), F.lit(SPACE)), _UPPER, _LOWER)


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(h, g, salt, id, key, pos)`` of every line long enough; 128 hash bits stand for the line."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.posexplode(split_lines(text_col)).alias("pos", "line")
    )
    kept = lines.withColumn("line", line_key("line")).where(F.length("line") >= min_chars)
    return kept.select(
        F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), F.col("line")).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"), "id", "key", "pos",
    )


def repeated_lines(found: DataFrame, min_docs: int) -> DataFrame:
    """``(h, g, n_docs, last)`` of the lines in at least ``min_docs`` documents.

    Hashes are range-partitioned and sorted by document, the largest first, and position. Each
    sorted run is streamed once: a row that opens a document counts, the first row of all names
    the largest document. The runs of a hash differ in the salt of their documents, so a line
    that everybody has is spread over many tasks and only their sums meet.
    """
    dealt = found.select("h", "g", "salt", "id", "pos").repartitionByRange("h", "g", "salt")
    run = Window.partitionBy("h", "g", "salt").orderBy(F.desc("id"), "pos")
    streamed = dealt.select("h", "g", "salt", "id", F.lag("id").over(run).alias("above"))
    opening = streamed.where(F.col("above").isNull() | (F.col("above") != F.col("id")))
    sums = opening.groupBy("h", "g", "salt").agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))
    whole = sums.groupBy("h", "g").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))
    return whole.where(F.col("n_docs") >= min_docs)


def drop_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
) -> DataFrame:
    """``(id, key, n_dropped, drops)`` of the documents that lose lines.

    ``drops`` is a compressed keep bitmap: a sorted array of ``(word, bits)`` in which bit ``i``
    of word ``w`` says that line ``64 w + i`` goes; 64 lines that all stay have no entry, and
    neither has a document that keeps all. ``key`` tells texts of one id apart.
    """
    found = stored(occurrences(docs, id_col, text_col, min_chars), "lines")
    # Stored, so that both sides of the join are plain and adaptive execution may split a common line.
    common = stored(repeated_lines(found, min_docs), "common-lines").select(F.col("h").alias("h_"), F.col("g").alias("g_"), "last")
    gone = found.join(common, (F.col("h") == F.col("h_")) & (F.col("g") == F.col("g_")) & (F.col("id") != F.col("last")))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    packed = gone.groupBy("id", "key", F.floor(F.col("pos") / _WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return packed.groupBy("id", "key").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops")
    )


def _fresh(names: list[str], taken: list[str]) -> list[str]:
    """Names that no column has, whatever its case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name in used:
            name = "_" + name
        out.append(name)
    return out


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with the lines of ``bitmaps`` taken out of the text, and with ``n_lines`` and ``n_dropped``.

    Counts of an earlier run, columns of these two names, are replaced; all others pass
    through. A row without a bitmap keeps its text as it is, null included; repeated rows all stay.
    """
    id_, key, n, drops, dense = _fresh(["__id", "__key", "__n", "__drops", "__dense"], docs.columns)
    marks = bitmaps.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("n_dropped").alias(n), F.col("drops").alias(drops))
    joined = docs.join(marks, (F.col(id_col) == F.col(id_)) & (text_key(text_col) == F.col(key)), "left")
    lines = split_lines(text_col)
    # Zeros fill the gap before every entry, so the work is that of the lines, however many go.
    joined = joined.withColumn(dense, F.when(F.col(n) > 0, F.expr(
        f"flatten(transform({drops}, (d, i) -> concat("
        f"array_repeat(0L, d.word - if(i = 0, -1, {drops}[i - 1].word) - 1), array(d.bits))))"
    )))
    bits = lambda i: F.coalesce(F.get(F.col(dense), F.floor(i / _WORD).cast("int")), F.lit(0).cast("bigint"))
    keeps = lambda line, i: F.getbit(bits(i), i % _WORD) == 0
    text = F.when(F.col(dense).isNotNull(), F.array_join(F.filter(lines, keeps), "\n")).otherwise(F.col(text_col)).alias(text_col)
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    counts = [F.size(lines).cast("bigint").alias("n_lines"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_dropped")]
    return joined.select(*[text if c == text_col else F.col(f"`{c}`") for c in others], *counts)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
) -> DataFrame:
    """Rows of ``docs`` without the lines that at least ``min_docs`` documents hold.

    Such a line (stripped, A-Z lower-cased, of ``min_chars`` code points or more) stays in the
    largest id that holds it, there with all its copies, and leaves all other documents. Rows
    with one id count as one document. A row without an id is no document: it counts for no line
    and keeps all its lines. A null text stays null and has one line, an empty table stays empty.
    Columns pass through, but for counts of an earlier run, ``n_lines`` and ``n_dropped``, which are
    replaced; so a result may be deduplicated again.
    """
    return apply_bitmaps(docs, drop_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
