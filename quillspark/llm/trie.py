"""The prefix trie of conversations, its subtrees summed by peeling leaves.

A node is a distinct sequence of first turns (role, text); the root is the empty
one. Members of a node are the conversations that start with it.

Keys. Turns get dense places in their conversations from ranges of one order of
all rows, so a conversation of any length is dealt over many tasks. A node's key
is the exclusive or of 128 bits of SHA-256 of (place, turn) along its path; it
is summed within ranges, and what a conversation has in earlier ranges is added.
Rows that share a key must share their last turn, else an error is raised: by
induction from the root, equal keys are then equal sequences.

Chains. Nodes of a path that have the same members have the same least member and
the same number of members, and no two other nodes do. They are one chain: only
the last of them has other than one child, only there conversations end. Within
a chain, sums over subtrees differ by the code points in between alone.

Peeling. Chains hold a counter of the chains that hang on them. Those at zero are
complete and send (1, leaves, saved tokens) to their parents in one message per
parent, summed before it is shuffled; a parent whose counter comes to zero is
complete in the next round, until only the root's chain finishes. Each round is
written to the shared folder; there are as many rounds as chains lie above one
another, whatever the number of turns.

Digests of the conversations that end at a node go by blocks of ids: up to
ID_BLOCK ids are joined before anything is shuffled by node, and a node's blocks
are hashed as a stream.

Turns are in order of turn (null first), then role and text, for turns that tie.
Null roles and texts count as empty. Rows without conv_id belong to no
conversation and are left out. Repeated rows are turns of their own. No rows, no
nodes, the root included. Other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import written

#: Conversation ids that are joined into one text before they are shuffled by node.
ID_BLOCK = 1024
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _in_ranges(rows: DataFrame, ranges: list, order: list, name: str) -> DataFrame:
    """rows in ranges of one order, written once, with `part` and the place `at` within it."""
    at = F.monotonically_increasing_id()
    out = written(rows.repartitionByRange(*ranges).sortWithinPartitions(*order).withColumn("at", at), name)
    return out.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))


def turns_of(conversations: DataFrame, conv_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, said, chars) with pos from 1 and said a SHA-256 of role and text, and conversations (conv, n)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    turn = F.col("turn").asc_nulls_first()
    # Bounds of ranges are drawn from starts of the texts, of which the driver meets a sample.
    ranged = rows.repartitionByRange("conv", turn, F.substring("role", 1, 32), F.substring("text", 1, 64)).sortWithinPartitions("conv", turn, "role", "text")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    ranged = written(ranged.select("conv", said.alias("said"), F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("at")), "turns")
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    parts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = ranged.withColumn("part", part).join(F.broadcast(parts), "part").select("conv", "said", "chars", (at + F.col("before")).alias("place"))  # parts: a row for each range
    convs = written(placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "conversations")
    turns = placed.join(convs, "conv").select("conv", (F.col("place") - F.col("first") + 1).alias("pos"), "said", "chars")
    return turns, convs.select("conv", "n")


def rebuilt(turns: DataFrame, convs: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversation c as the first h turns of c - c % family, then its own turns after its first h; h is crc32 of c in decimals, modulo most; % takes the sign of c, as in SQL."""
    base = F.col("conv") - F.col("conv") % family
    plan = convs.select("conv", base.alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"))
    heads = convs.filter(F.col("conv") % family == 0).select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(heads, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m"))
    shared = turns.filter((F.col("conv") % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    shared = plan.join(shared, "base").filter("pos <= m").select("conv", "pos", "said", "chars")
    own = turns.join(plan.select("conv", "h", "m"), "conv").filter("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "said", "chars")
    return shared.unionByName(own), convs


def _bits(digest: Column, at: int) -> Column:
    """16 hexadecimal digits as a signed long."""
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def keyed(turns: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, g1, g2, chars, total): keys of the nodes that conversations pass, bits of their last turn, code points up to them."""
    digest = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("said")), 256)
    rows = turns.withColumn("d", digest).select("conv", "pos", "chars", _bits(F.col("d"), 1).alias("g1"), _bits(F.col("d"), 17).alias("g2"))
    ranged = _in_ranges(rows, ["conv", "pos"], ["conv", "pos"], "places")
    sums = {"k1": F.bit_xor("g1"), "k2": F.bit_xor("g2"), "total": F.sum("chars")}
    pieces = ranged.groupBy("part", "conv").agg(*(c.alias(n) for n, c in sums.items()))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = {"k1": F.bit_xor("k1"), "k2": F.bit_xor("k2"), "total": F.sum("total")}
    # Of a range only the first conversation can have earlier turns in other ranges: at most a row for each range.
    pieces = pieces.select("part", "conv", *(c.over(earlier).alias(f"e_{n}") for n, c in carried.items())).filter(F.col("e_total").isNotNull())
    within = Window.partitionBy("part", "conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.repartition("part", "conv").select("part", "conv", F.col("pos").alias("depth"), "g1", "g2", "chars", *(c.over(within).alias(n) for n, c in sums.items()))
    rows = rows.join(F.broadcast(pieces), ["part", "conv"], "left")
    add = lambda n: F.coalesce(F.col(f"e_{n}"), F.lit(0))
    return rows.select("conv", "depth", "g1", "g2", "chars", F.col("k1").bitwiseXOR(add("k1")).alias("k1"), F.col("k2").bitwiseXOR(add("k2")).alias("k2"), (F.col("total") + add("total")).alias("total"))


KEY = ["depth", "k1", "k2"]


def _nodes(passed: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    root = convs.select("conv", *(zero.alias(c) for c in ("depth", "g1", "g2", "chars", "k1", "k2", "total")))
    nodes = passed.unionByName(root).groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"), F.min("total").alias("total"),
        *(f(g).alias(f"{n}_{g}") for g in ("g1", "g2") for n, f in (("least", F.min), ("most", F.max))),
    )
    same = (F.col("least_g1") == F.col("most_g1")) & (F.col("least_g2") == F.col("most_g2"))
    sure = lambda g: F.when(same, F.col(f"least_{g}")).otherwise(F.raise_error(F.lit("different turns share a key")).cast("long"))
    return nodes.select(*KEY, "conv_id", "n_convs", "chars", "total", F.col("k1").bitwiseXOR(sure("g1")).alias("p1"), F.col("k2").bitwiseXOR(sure("g2")).alias("p2"))


def _digests(batches):
    import pyarrow as pa

    kinds = [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

    at, digest, done = None, None, []
    for batch in batches:
        for *key, ids in zip(*(batch.column(n).to_pylist() for n in (*KEY, "ids")), strict=True):
            if key != at:
                if at:
                    done.append((*at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield out(done)
            done = []
    if at:
        yield out([(*at, digest.hexdigest())])


def _ends(passed: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes at which conversations end."""
    last = passed.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("end"))
    at = convs.join(last, "conv", "left").select("conv", *(F.coalesce(F.col(f"end.{c}"), F.lit(0)).alias(c) for c in KEY))
    block = F.shiftright("conv", ID_BLOCK.bit_length() - 1)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    blocks = at.groupBy(*KEY, block.alias("block")).agg(ids.alias("ids"))
    return blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def _chains(nodes: DataFrame) -> DataFrame:
    """A row for each chain: what it is, on which chain it hangs, how many hang on it, the tokens it saves itself."""
    top = F.min(F.struct("depth", "p1", "p2", "chars", "total"))
    bottom = F.max(F.struct(*KEY, "total"))
    chains = written(nodes.groupBy("conv_id", "n_convs").agg(top.alias("top"), bottom.alias("bottom")), "chains")
    keys = chains.filter("top.depth > 0").select("conv_id", "n_convs", (F.col("top.depth") - 1).alias("depth"), F.col("top.p1").alias("k1"), F.col("top.p2").alias("k2"))
    root = nodes.filter("depth = 0").select(F.col("conv_id").alias("parent_conv"), F.col("n_convs").alias("parent_n")).first()
    if root is None:
        up = keys.select("conv_id", "n_convs", F.lit(None).cast("long").alias("parent_conv"), F.lit(None).cast("long").alias("parent_n"))
    else:  # the root may have the most children by far and is known
        parents = nodes.select(*KEY, F.col("conv_id").alias("parent_conv"), F.col("n_convs").alias("parent_n")).filter("depth > 0")
        up = keys.filter("depth > 0").join(parents, KEY).select("conv_id", "n_convs", "parent_conv", "parent_n")
        first = keys.filter("depth = 0").select("conv_id", "n_convs", F.lit(root["parent_conv"]).alias("parent_conv"), F.lit(root["parent_n"]).alias("parent_n"))
        up = up.unionByName(first)
    up = written(up, "parents")
    kids = up.groupBy(F.col("parent_conv").alias("conv_id"), F.col("parent_n").alias("n_convs")).agg(F.count(F.lit(1)).alias("kids"))
    gain = (F.col("n_convs") - 1) * (F.col("bottom.total") - F.col("top.total") + F.col("top.chars"))
    return chains.join(up, ["conv_id", "n_convs"], "left").join(kids, ["conv_id", "n_convs"], "left").select(
        "conv_id", "n_convs", "parent_conv", "parent_n", F.coalesce("kids", F.lit(0)).cast("long").alias("kids"), gain.alias("gain"),
        F.col("top.depth").alias("top"), F.col("bottom.depth").alias("bottom"), F.col("bottom.k1").alias("b1"), F.col("bottom.k2").alias("b2"), F.col("bottom.total").alias("bottom_total"),
    )


def peel(chains: DataFrame) -> DataFrame:
    """(conv_id, n_convs, leaves, below) of chains (conv_id, n_convs, parent_conv, parent_n, kids, gain): leaves and saved tokens of the subtrees that hang on each.

    Each round is as large as the chains that still wait, and only those with kids ever do.
    """
    chain = ["conv_id", "n_convs"]
    new = chains.filter("kids = 0").select(*chain, "parent_conv", "parent_n", "gain", F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("below"))
    waiting = chains.filter("kids > 0").select(*chain, "parent_conv", "parent_n", "gain", F.col("kids").alias("remaining"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("below"))
    done = new.select(*chain, "leaves", "below")
    while not waiting.isEmpty():
        sent = new.filter("parent_n is not null").groupBy(F.col("parent_conv").alias("conv_id"), F.col("parent_n").alias("n_convs"))
        sent = sent.agg(F.count(F.lit(1)).alias("sent"), F.sum("leaves").alias("more_leaves"), F.sum(F.col("below") + F.col("gain")).alias("more_below"))
        got = lambda c: F.coalesce(F.col(c), F.lit(0))
        step = written(
            waiting.join(sent, chain, "left").select(
                *chain, "parent_conv", "parent_n", "gain", (F.col("remaining") - got("sent")).alias("remaining"), (F.col("leaves") + got("more_leaves")).alias("leaves"), (F.col("below") + got("more_below")).alias("below")
            ),
            "peeled",
        )
        new, waiting = step.filter("remaining = 0"), step.filter("remaining > 0")
        if new.isEmpty():
            raise RuntimeError("no chain was completed in a round: the parents form a cycle")
        done = done.unionByName(new.select(*chain, "leaves", "below"))
    return done


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node of the trie of turns (conv, pos, said, chars); convs (conv) are also those without turns."""
    passed = written(keyed(turns), "passed")
    nodes = written(_nodes(passed, convs), "nodes")
    chains = written(_chains(nodes), "hanging")
    chain = ["conv_id", "n_convs"]
    ends = _ends(passed, convs).withColumnsRenamed({"depth": "bottom", "k1": "b1", "k2": "b2"})
    totals = chains.join(peel(chains), chain).join(ends, ["bottom", "b1", "b2"], "left").select(*chain, "parent_conv", "kids", "top", "bottom", "bottom_total", "leaves", "below", "ends_sha256")
    at_bottom = F.col("depth") == F.col("bottom")
    return nodes.join(totals, chain).select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("top"), F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(at_bottom, F.col("kids")).otherwise(F.lit(1).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (F.col("bottom_total") - F.col("total") + F.col("chars")) + F.col("below")).alias("saved_tokens"),
        F.when(at_bottom, F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The trie of conversations as they are."""
    return prefix_trie(*turns_of(conversations, conv_col))


def rebuilt_trie(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The trie of conversations that share the first turns of their family's first one; see rebuilt."""
    return prefix_trie(*rebuilt(*turns_of(conversations, conv_col)))
