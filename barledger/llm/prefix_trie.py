"""Prefix trie of conversations by block digests, with totals over its subtrees.

Turns become 128-bit digests at once, so texts are never shuffled. Conversations are cut into blocks of BLOCK turns; a
block's digest, and that of all blocks before it, group the conversations first, so equal blocks are one row with a count.
Only blocks whose parent continues in different ways are refined turn by turn; a block without siblings is a chain of
nodes that its first conversation alone describes. The digest of a prefix is the exclusive or of its turns' digests, each
of which includes its position: prefixes of conversations of any length are running totals that many tasks share.

A node belongs to the smallest conversation through it. The nodes of a conversation form a chain down to its end, and
chains hang from nodes of smaller conversations. Sums over subtrees are summed over the tree of chains by doubling jumps,
then along each chain by running totals, so neither long conversations nor deep tries make many rounds.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import release
from barledger.llm.shared import bound_batches, stored
from barledger.operators.scans import ranked, running
from barledger.operators.skew import attach_by_key, row_counts

#: Turns of a block.
BLOCK = 8
#: Bits of an id within which the ids of a node's ends are joined to one string.
END_BITS = 13
#: Sets the second half of each digest apart from the first.
SALT = 0x5EED
HEADS = 9
GROUP = 5
NODE = ("depth", "x", "y")
ABOVE = ("above", "px", "py")


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, at (position from 0), a and b (digest of role and text), bytes (of the text in UTF-8).

    Turns are ordered by `turn`, null first, ties by role and then by digest. Null roles and texts are empty. Rows without
    conv_id belong to no conversation and are left out.
    """
    picked = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    digested = picked.select(
        "conv_id", "turn", "role", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(SALT), "text", "role").alias("b"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    return ranked(digested, ["conv_id"], ["turn", "role", "a", "b"], "at").select("conv_id", "at", "a", "b", "bytes")


def with_borrowed_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and all conversations: the first h turns of conv_id - conv_id % 5, then one's own after h.

    h is crc32 of the decimal conv_id, mod 9. An absent lender lends nothing, a short one all it has.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    lender = F.col("conv_id") - F.col("conv_id") % GROUP
    lent = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    facts = stored(
        sizes.withColumn("lender", lender).withColumn(
            "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
        ).join(lent, "lender", "left").select(
            "conv_id", "lender", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken")
        ),
        "conversations",
    )
    own = turns.join(facts.select("conv_id", "h", "taken"), "conv_id").where("at >= h")
    own = own.withColumn("at", F.col("at") - F.col("h") + F.col("taken"))
    reach = F.explode(F.sequence(F.lit(1 - GROUP), F.lit(GROUP - 1)))
    heads = turns.where((F.col("at") < HEADS - 1) & (F.col("conv_id") % GROUP == 0))
    heads = heads.withColumnRenamed("conv_id", "lender").withColumn("step", reach)
    heads = heads.withColumn("conv_id", F.try_add(F.col("lender"), F.col("step").cast("bigint")))
    heads = heads.join(facts.select("conv_id", "lender", "taken"), ["conv_id", "lender"]).where("at < taken")
    columns = ["conv_id", "at", "a", "b", "bytes"]
    return own.select(columns).unionByName(heads.select(columns)), facts.select("conv_id")


def block_groups(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of the conversations with the digests before them; and the different ones: members, first, alone.

    `alone` says that the prefix before the block continues in this way only.
    """
    blocks = turns.groupBy("conv_id", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count(F.lit(1)).alias("n")
    )
    blocks = running(stored(blocks, "blocks"), ["conv_id"], "block", {}, {"tx": "x", "ty": "y"}, span=512)
    blocks = stored(
        blocks.withColumn("px", F.col("tx").bitwiseXOR(F.col("x"))).withColumn("py", F.col("ty").bitwiseXOR(F.col("y")))
        .drop("tx", "ty"),
        "prefixes",
    )
    before = ["block", "px", "py"]
    groups = stored(
        blocks.groupBy(*before, "x", "y", "n").agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("first")),
        "groups",
    )
    ways = row_counts(groups, before, "ways").withColumn("alone", F.col("ways") == 1)
    return blocks, attach_by_key(groups.select(*before, "members", "first"), ways, before, "ways")


def nodes_of(turns: DataFrame, groups: DataFrame, conversations: DataFrame) -> DataFrame:
    """NODE, ABOVE (the parent's NODE), conv_id (smallest member), n_convs and bytes of each node, the root included."""
    block = F.expr(f"at div {BLOCK}")
    inside = turns.select(F.col("conv_id").alias("first"), block.alias("block"), "at", "x", "y", "bytes").join(
        groups, ["first", "block"]
    )
    upto = running(stored(inside, "inside"), ["first", "block"], "at", {}, {"tx": "x", "ty": "y"})
    x, y = (F.col(f"p{k}").bitwiseXOR(F.col(f"t{k}")) for k in "xy")
    steps = stored(
        upto.select(
            (F.col("at") + 1).alias("depth"), x.alias("nx"), y.alias("ny"), F.col("at").alias("above"),
            x.bitwiseXOR(F.col("x")).alias("px"), y.bitwiseXOR(F.col("y")).alias("py"), F.col("first").alias("conv_id"),
            F.col("members").alias("n_convs"), "bytes", "alone",
        ).withColumnsRenamed({"nx": "x", "ny": "y"}),
        "steps",
    )
    refined = steps.where(~F.col("alone")).groupBy(*NODE, *ABOVE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("bytes").alias("bytes")
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *(zero.alias(c) for c in NODE), *(none.alias(c) for c in ABOVE), "conv_id", "n_convs", zero.alias("bytes")
    )
    return stored(steps.where("alone").drop("alone").unionByName(refined).unionByName(root), "nodes")


def ends_of(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """NODE, ends_sha256 and first_end of each node at which conversations end.

    Ids are joined to strings within ranges of 2 ** END_BITS ids; a node's strings then pass through one task in order, a
    piece at a time, because the digest of their sequence can't be divided.
    """
    bound_batches(blocks.sparkSession)
    whole = blocks.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    zero = F.lit(0).cast("bigint")
    ends = conversations.join(whole, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in NODE)
    )
    pieces = ends.groupBy(*NODE, F.shiftright("conv_id", END_BITS).alias("piece")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("ids")
    )
    pieces = pieces.select(
        *NODE, "piece", F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("text"),
        F.element_at("ids", 1).alias("first_end"),
    )

    def digest(batches):
        release("packing")
        node, sha, first = None, None, None
        for batch in batches:
            done = []
            for *key, _, text, smallest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        done.append((*node, sha.hexdigest(), first))
                    node, sha, first = key, hashlib.sha256(), smallest
                sha.update(text.encode())
            if done:
                yield rows_of(done)
        if node is not None:
            yield rows_of([(*node, sha.hexdigest(), first)])

    def rows_of(done):
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*done, strict=True)], [*NODE, "ends_sha256", "first_end"]
        )

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return ordered.mapInArrow(digest, "depth bigint, x bigint, y bigint, ends_sha256 string, first_end bigint")


def chains_of(nodes: DataFrame) -> DataFrame:
    """conv_id, top (depth of the chain's first node), parent (conv_id of the node above it), saved (by its own nodes)."""
    chains = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", *ABOVE[1:])).alias("head"),
        F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    ).select("conv_id", F.col("head.depth").alias("top"), "head.px", "head.py", "saved")
    chains = stored(chains, "heads").withColumn("above", F.col("top") - 1)
    deeper = chains.where("top > 1")
    asked = row_counts(deeper, ABOVE, "asked")
    owners = nodes.select(*(F.col(n).alias(a) for n, a in zip(NODE, ABOVE)), F.col("conv_id").alias("parent"))
    placed = attach_by_key(deeper, owners.join(asked, list(ABOVE)), ABOVE, "asked")
    root = nodes.where("depth = 0").select("conv_id").first()  # one number
    owner = F.when(F.col("top") == 1, F.lit(root["conv_id"] if root else None)).cast("bigint")
    top = chains.where("top <= 1").withColumn("parent", owner)
    columns = ["conv_id", "top", "parent", "saved"]
    return stored(placed.select(columns).unionByName(top.select(columns)), "chains")


def chain_totals(chains: DataFrame) -> DataFrame:
    """conv_id, saved, leaves: each chain's own values and those of all chains below it.

    In round k a chain adds its sum over fewer than 2 ** k steps to the chain 2 ** k steps above and then looks twice as far,
    so there are as many rounds as the height has binary digits.
    """
    totals = chains.select("conv_id", F.col("parent").alias("up"), "saved", "leaves")
    while totals.where("up IS NOT NULL").limit(1).count():
        below = totals.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"), F.count(F.lit(1)).alias("asked")
        )
        summed = stored(totals.join(below, "conv_id", "left"), "summed")
        jumps = summed.where("asked IS NOT NULL AND up IS NOT NULL").select(
            F.col("conv_id").alias("up"), F.col("up").alias("further"), "asked"
        )
        totals = stored(
            attach_by_key(summed.drop("asked"), jumps, ["up"], "asked").select(
                "conv_id", F.col("further").alias("up"),
                *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")),
            ),
            "totals",
        )
    return totals.drop("up")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of conversations, whose turns are those of turn_digests.

    conv_id (smallest member), depth, parent_conv_id (of the root null), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Conversations (conv_id, each once) without a turn are members of the root. Equal conversations share all
    their nodes. Without conversations there are no nodes.
    """
    key = lambda *more: F.xxhash64(*more)
    turns = stored(
        turns.select(
            "conv_id", "at", key("at", "a", "b").alias("x"), key(F.lit(SALT), "b", "a", "at").alias("y"), "bytes"
        ),
        "turns",
    )
    blocks, groups = block_groups(turns)
    nodes = nodes_of(turns, groups, conversations)
    nodes = stored(nodes.join(ends_of(blocks, conversations), list(NODE), "left"), "ended")
    chains = chains_of(nodes)
    hung = stored(
        chains.where("parent IS NOT NULL").groupBy("parent", (F.col("top") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("hanging")).withColumnRenamed("parent", "conv_id"),
        "hung",
    )
    last = F.col("first_end") == F.col("conv_id")
    ended = nodes.where(last).join(hung, ["conv_id", "depth"], "left").select(
        "conv_id", F.col("hanging").isNull().cast("bigint").alias("leaves")
    )
    chains = stored(chains.join(ended, "conv_id"), "chains")
    below = chains.join(chain_totals(chains).withColumnsRenamed({"saved": "all_saved", "leaves": "all_leaves"}), "conv_id")
    below = below.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("hanging"), F.sum("all_saved").alias("saved"), F.sum("all_leaves").alias("leaves")
    )
    zero = F.lit(0).cast("bigint")
    own = nodes.join(below, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "n_convs", "ends_sha256", (-F.col("depth")).alias("from_end"),
        ((F.col("n_convs") - 1) * F.col("bytes") + F.coalesce("saved", zero)).alias("saved"),
        (F.coalesce("leaves", zero) + (F.coalesce(last, F.lit(False)) & F.col("hanging").isNull()).cast("bigint")).alias("leaves"),
        (F.coalesce("hanging", zero) + (~F.coalesce(last, F.lit(False))).cast("bigint")).alias("n_children"),
    )
    summed = running(stored(own, "own"), ["conv_id"], "from_end", {"saved_tokens": "saved", "n_leaves": "leaves"})
    tops = chains.select("conv_id", F.col("top").alias("depth"), "parent", F.lit(True).alias("is_top"))
    parent: Column = F.when(F.col("is_top"), F.col("parent")).otherwise(F.col("conv_id"))
    return summed.join(tops, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, borrow: bool = False) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text); with borrow, of its conversations rebuilt with heads.

    Null, tied and repeated turns are ordered as turn_digests says; empty and long texts and other columns are no matter.
    """
    turns = stored(turn_digests(conversations), "digests")
    if borrow:
        return trie(*with_borrowed_heads(turns))
    return trie(turns, turns.select("conv_id").distinct())
