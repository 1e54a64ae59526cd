"""The trie of conversations' common beginnings, by ROLLUP over columns of turn ids."""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import stored
from forecourt.operators.lookup import bounded

#: Positions of one column block; a conversation has a row for every so many turns.
WIDTH = 8
#: Original turns that a rebuilt conversation may take from its first of a hundred, at most.
BORROWED = 5
#: Ids that are joined to one string before strings meet.
CHUNK = 4096

_SLOTS = [f"t{j}" for j in range(1, WIDTH + 1)]
_KEY = ["block", "k1", "k2"]
_NODE = ["depth", "p1", "p2"]


def _running(df: DataFrame, key: str, order: list[Column], column: Column, how: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum or exclusive-or of ``column`` over a key's rows up to each one.

    Rows are range-partitioned by key and order, so a hot key spans many partitions. Each part runs by
    itself and begins with what the key's earlier parts add up to; only keys that cross a border
    have such parts, at most two for each partition, which is what the broadcast table holds.
    """
    add = F.sum if how == "sum" else F.bit_xor
    spread = df.withColumn("__value", column).repartitionByRange(F.col(key), *order)
    placed = stored(spread.withColumn("__part", F.spark_partition_id()), "running")
    parts = placed.groupBy(key, "__part").agg(add("__value").alias("__total"))
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("__before", add("__total").over(earlier)).where(F.col("__before").isNotNull())
    before = bounded(before.select(F.col(key).alias("__key"), F.col("__part").alias("__at"), "__before"))[0]
    joined = placed.join(before, (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__at")), "left")
    here = add("__value").over(Window.partitionBy(key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rest = F.coalesce("__before", F.lit(0))
    total = here + rest if how == "sum" else here.bitwiseXOR(rest)
    return joined.select(*df.columns, total.alias(name))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, a, b, len)``: numbered turns, their texts as 128-bit ids and lengths in code points.

    Turns are ordered by number, null first, equal numbers by their ids. A null role or text is
    empty; rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("~"), text, role).alias("b"), F.length(text).alias("len"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    return _running(rows, "conv_id", order, F.lit(1).cast("bigint"), "sum", "pos").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv_id, total, pos, a, b, len)`` and conversations ``(conv_id, total)``.

    Conversation c begins with the first h turns of conversation c - c % 100, h being crc32(c) % 6,
    and goes on with its own after its first h.
    """
    borrowed = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BORROWED + 1))
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", borrowed)
    first = turns.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= BORROWED))
    parts = F.sort_array(F.collect_list(F.struct("pos", "a", "b", "len")))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(parts.alias("head"))  # five turns at most
    convs = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(heads, "base", "left")
    taken = F.filter(F.coalesce("head", F.expr("array()")), lambda x: x["pos"] <= F.col("h"))
    convs = convs.withColumn("head", taken).withColumn("k", F.size("head"))
    convs = convs.withColumn("total", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "h", "k", "total", "head"), "conversations")
    borrowed_turns = convs.select("conv_id", "total", F.explode("head").alias("x")).select("conv_id", "total", "x.*")
    own_turns = turns.join(convs.select("conv_id", "h", "k", "total"), "conv_id").where(F.col("pos") > F.col("h"))
    moved = own_turns.withColumn("pos", F.col("k") + F.col("pos") - F.col("h"))
    names = ["conv_id", "total", "pos", "a", "b", "len"]
    return borrowed_turns.select(*names).unionByName(moved.select(*names)), convs.select("conv_id", "total")


def blocks_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and block: ``(block, k1, k2, conv_id, total, t1 … t8)``.

    A turn id is two hashes of position and text, and the text's length. The exclusive-or of a
    path's ids names the node that it ends in: 128 bits. ``(k1, k2)`` names the node
    that the prior block ended in. A conversation without turns has an empty first block.
    """
    place = F.col("pos") - 1
    slot = F.struct(F.xxhash64("pos", "a", "b").alias("u"), F.xxhash64("b", "pos", "a").alias("v"), F.col("len"))
    placed = turns.select("conv_id", "total", F.floor(place / WIDTH).cast("int").alias("block"), (place % WIDTH + 1).alias("slot"), slot.alias("t"))
    rows = placed.groupBy("conv_id", "total", "block").agg(
        *[F.max(F.when(F.col("slot") == j, F.col("t"))).alias(f"t{j}") for j in range(1, WIDTH + 1)],
        F.bit_xor("t.u").alias("x1"), F.bit_xor("t.v").alias("x2"),
    )
    rows = stored(rows, "conversation-blocks")
    names = [*_KEY, "conv_id", "total", *_SLOTS]
    zero = F.lit(0).cast("bigint")
    short = rows.where(F.col("total") <= WIDTH).withColumns({"k1": zero, "k2": zero}).select(*names)
    long = rows.where(F.col("total") > WIDTH)
    if not long.isEmpty():
        for k, x in (("k1", "x1"), ("k2", "x2")):
            long = _running(long, "conv_id", [F.col("block")], F.col(x), "xor", k).withColumn(k, F.col(k).bitwiseXOR(F.col(x)))
        short = short.unionByName(long.select(*names))
    empty = convs.where("total = 0").select(
        F.lit(0).alias("block"), zero.alias("k1"), zero.alias("k2"), "conv_id", "total",
        *[F.lit(None).cast(rows.schema[s].dataType).alias(s) for s in _SLOTS],
    )
    return stored(short.unionByName(empty), "keyed-blocks")


def _rolled(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of the blocks together, one row per node: a ROLLUP over the turn-id columns.

    ``level`` says how many columns a row is grouped by. A prefix that goes on behind the end of its
    conversation is no node, nor is the empty prefix of a later block, which its key's node is.
    """
    slots = ", ".join(_SLOTS)
    found = rows.sparkSession.sql(
        f"SELECT block, k1, k2, {WIDTH} - bit_count(grouping_id()) AS level, {slots}, {aggregates} "
        f"FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({slots})", rows=rows,
    )
    last = F.get(F.array(*_SLOTS), F.col("level") - 1)
    found = found.withColumn("last", last).where(F.col("last").isNotNull() | ((F.col("level") == 0) & (F.col("block") == 0)))
    p1, p2 = F.col("k1"), F.col("k2")
    for s in _SLOTS:
        p1 = p1.bitwiseXOR(F.coalesce(F.col(s)["u"], F.lit(0)))
        p2 = p2.bitwiseXOR(F.coalesce(F.col(s)["v"], F.lit(0)))
    return found.withColumns({"depth": F.col("block").cast("bigint") * WIDTH + F.col("level"), "p1": p1, "p2": p2})


def _below(nodes: DataFrame) -> DataFrame | None:
    """``(block, k1, k2, leaves, saved)``: what a later block's key has below it, in its and all later blocks.

    The keys form a tree of blocks. Its sums are made by doubling: after n rounds every key holds what
    lies less than 2^n blocks below, so a conversation of n blocks takes log n rounds.
    """
    deepest = nodes.agg(F.max("block")).first()[0] or 0
    if not deepest:
        return None
    own = nodes.where("block > 0").groupBy(*_KEY).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    over = nodes.where((F.col("level") == WIDTH)).select(
        (F.col("block") + 1).alias("block"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    )
    state, reach = stored(own.join(over, _KEY), "block-sums"), 1
    while reach < deepest:
        up = state.where(F.col("block") > reach)
        gained = up.groupBy((F.col("block") - reach).alias("block"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select((F.col("block") + reach).alias("block"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        state = state.join(gained, _KEY, "left").join(above, ["block", "u1", "u2"], "left").select(
            *_KEY, (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.col("w1").alias("u1"), F.col("w2").alias("u2"),
        )
        state, reach = stored(state, "block-sums"), reach * 2
    return state.drop("u1", "u2")


def _ends(blocks: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)``: the hash of the ids of the conversations that end in a node.

    Ids are joined in chunks of neighbours first; a node's chunks then stream through one hash in order, so
    a task holds a chunk at a time, however many conversations end in one node.
    """
    path = {"p1": F.col("k1"), "p2": F.col("k2")}
    for s in _SLOTS:
        path = {p: c.bitwiseXOR(F.coalesce(F.col(s)[f], F.lit(0))) for (p, c), f in zip(path.items(), ("u", "v"))}
    ending = blocks.where(F.col("total") <= (F.col("block").cast("bigint") + 1) * WIDTH).select(
        F.col("total").cast("bigint").alias("depth"), path["p1"].alias("p1"), path["p2"].alias("p2"), "conv_id", F.floor(F.col("conv_id") / CHUNK).alias("chunk")
    )
    chunks = ending.groupBy(*_NODE, "chunk").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches):
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch[c] for c in (*_NODE, "ids"))):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*_NODE, "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, digest.hexdigest())], columns=[*_NODE, "ends_sha256"])

    lined = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").drop("chunk")
    return lined.mapInPandas(run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` per node.

    The table has ``conv_id, turn, role, text``; other columns are ignored. A node is a distinct
    beginning of rebuilt conversations; ``conv_id``, its smallest member, and ``depth`` identify it. A
    conversation without turns after rebuilding is a member of the root alone. Repeated rows are
    repeated turns. An empty table has no node. Rows without a conversation are left out.
    """
    turns, convs = rebuilt(stored(turns_of(conversations), "turns"))
    blocks = blocks_of(turns, convs)
    level_length = F.coalesce(F.col("last")["len"], F.lit(0)).cast("bigint")
    nodes = _rolled(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs, max(total) AS longest").select(
        *_KEY, *_SLOTS, *_NODE, "level", "conv_id", "n_convs", (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * level_length).alias("saved"),
    )
    nodes = stored(nodes, "trie-nodes")
    below = _below(nodes)
    summed = nodes
    if below is not None:
        hung = below.select(
            (F.col("block") - 1).alias("block"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
            F.lit(WIDTH).cast(nodes.schema["level"].dataType).alias("level"), F.col("leaves").alias("more_leaf"), F.col("saved").alias("more_saved"))
        summed = nodes.join(hung, ["block", "level", "p1", "p2"], "left").withColumns({
            "leaf": F.col("leaf") + F.coalesce("more_leaf", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0))})
    # A node is the smallest and the largest of its subtree, so the second ROLLUP hands on the first's values too.
    trees = _rolled(summed, "min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens")
    last = F.col("last")
    q1, q2 = F.col("p1").bitwiseXOR(last["u"]), F.col("p2").bitwiseXOR(last["v"])
    trees = trees.select(*_NODE, q1.alias("q1"), q2.alias("q2"), "conv_id", "n_convs", "n_leaves", "saved_tokens")
    trees = stored(trees, "trie-sums")
    children = trees.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.lit(1).alias("child"))
    everything = trees.unionByName(children, allowMissingColumns=True).unionByName(_ends(blocks), allowMissingColumns=True)
    values = ("q1", "q2", "conv_id", "n_convs", "n_leaves", "saved_tokens", "ends_sha256")
    whole = everything.groupBy(*_NODE).agg(*[F.max(c).alias(c) for c in values], F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"))
    parents = trees.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    found = whole.join(parents, ["depth", "q1", "q2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
