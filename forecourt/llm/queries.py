"""Registered queries of the operators, one for each, over whole tables with production parameters."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (
    bpe_transducer, decontaminate, line_dedup, packing, prefix_trie, quality, sharding, simhash, token_counts, token_files,
    toxicity, url_filter, whitening,
)
from forecourt.llm.common import read
from forecourt.llm.encoding import token_file
from forecourt.session import shared_folder

#: The end id of token files, and the tokenizers of the queries.
END_OF_DOCUMENT = 2
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Rules for hosts and paths.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
#: Words in a host that mark it as unwanted; with the blocking rules they label URLs to learn from.
URL_SEEDS = ("casino", "bets", "pills", "adult", "spam", "ads-")
#: What the counting query edits: runs of six digits or more become one mark.
DIGITS, DIGIT_MARK = r"[0-9]{6,}", "<number>"


def simhash_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.clusters(read(spark, folder, "documents"), shingle=3, radius=3)
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(read(spark, folder, "documents"), path, token_file(WORD_BPE), "words", END_OF_DOCUMENT)
    found = token_files.read_tokens(spark, path)
    return found.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    host = url_filter.host_of()
    seeded = F.lit(False)
    for seed in URL_SEEDS:
        seeded = seeded | F.contains(host, F.lit(seed))
    parts = pages.select("url", host.alias("host"), url_filter.path_of().alias("path"), seeded.alias("seeded"))
    # The policy labels every URL: what a seed or a rule blocks is unwanted, all else is wanted.
    rule = url_filter.matching_rule(URL_RULES)
    blocks = F.coalesce(rule.isin([r for r, verdict in URL_RULES.items() if verdict == "block"]), F.lit(False))
    labelled = parts.select("url", (F.col("seeded") | blocks).cast("int").alias("blocked"))
    return url_filter.judge(pages, URL_RULES, url_filter.train(labelled))


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(read(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    found = packing.pack_documents(docs, token_file(BYTE_BPE), "bytes", capacity=2048, end_id=0)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "start_word", "end_word")


def deduplicated_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, folder, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counts_after(read(spark, folder, "documents"), token_file(BYTE_BPE), DIGITS, DIGIT_MARK)


def document_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id", sharding.record_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 5 == 0
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    scored = toxicity.classify(docs, labels.where(~held_out("doc_id")))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(read(spark, folder, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def transducer_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe_transducer.encode_documents(read(spark, folder, "documents"), token_file(WORD_BPE), decode=True)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, folder, "conversations"))


QUERIES = {
    "op1_simhash_near_dedup": simhash_clusters,
    "op2_quality_rules": quality_rules,
    "op3_token_id_files": token_id_files,
    "op4_url_filters": url_verdicts,
    "op5_best_fit_packing": best_fit_packing,
    "op6_benchmark_decontamination": benchmark_leaks,
    "op7_line_dedup": deduplicated_lines,
    "op8_token_counts": edited_token_counts,
    "op9_sharding": document_shards,
    "op10_toxicity": toxicity_scores,
    "op11_embedding_whitening": whitened_embeddings,
    "op12_bpe_transducer": transducer_round_trip,
    "op13_conversation_trie": conversation_trie,
}

#: The others need a tokenizer, a learned model, an exclusive-or of hashes or an edit distance.
ORACLES = {
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, i AS pos, parts[i] AS line,
         translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d, range(1, len(parts) + 1) r(i)
), common AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, c.k IS NOT NULL AND l.doc_id <> c.last AS gone FROM lines l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op13_conversation_trie": r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(x ORDER BY pos) AS xs FROM turns GROUP BY conv_id
), digits AS (
  SELECT conv_id, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: list_transform(range(8), lambda i: CAST((ord(c) >> CAST(i AS INT)) & 1 AS BIGINT)))) AS bits FROM own
), crc AS (
  SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bits),
    lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)), CAST(4294967295 AS BIGINT)) % 6 AS h FROM digits
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.xs, [])[1:h], o.xs[h + 1:]) AS path
  FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), members AS (
  SELECT conv_id, path[1:d] AS node, d AS depth, d = len(path) AS is_end FROM rebuilt, range(0, 1 + len(path)) r(d)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), own_values AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children,
         (n_convs - 1) * coalesce(length(node[depth].t), 0) AS saved
  FROM nodes n
), sums AS (
  SELECT v.node[1:d] AS node, d AS depth, count(*) FILTER (v.n_children = 0) AS n_leaves, CAST(sum(v.saved) AS BIGINT) AS saved_tokens
  FROM own_values v, range(0, 1 + v.depth) r(d) GROUP BY 1, 2
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM own_values v JOIN sums s ON s.depth = v.depth AND s.node = v.node
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1]
""",
}
