"""Conversation prefix trie, built level by level.

The turns of conversations become steps: a depth from 1, the SHA-256 of role and
text, and its code points. Conversations with the same steps are one sequence,
with its copies, so that exact copies never meet again.

Down: at each depth the live sequences are grouped by (parent node, next step);
a group is a node and is named by its least conversation. Sequences that are
alone in their node leave the loop: below that node they are a chain, and chains
of any length are put together at once. So there are as many rounds as steps
that two different conversations share, not as the longest conversation has.

Up: level by level, nodes join the sums of their children: leaves and savings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import stored
from terrafold.operators.positions import positions

#: Levels after which what live sequences have left is written anew.
SPAN = 8
ENDS = "rep long, ends_sha256 string"


def steps_of(turns: DataFrame) -> DataFrame:
    """(conv_id, step from 0, key, tokens) of turns (conv_id, turn, role, text); tokens are the text's code points.

    Rows go by turn, nulls first, and rows that share a turn by key, the SHA-256 of the role's length, role and text.
    Null roles and texts are empty. Rows without a conv_id belong to no conversation. Places come from ranges of
    sorted rows, so the longest conversation may span many tasks, and texts are not moved.
    """
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    key = F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), key.alias("key"), F.length(text).cast("long").alias("tokens"))
    placed = stored(positions(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key")]))
    first = stored(placed.groupBy("conv_id").agg(F.min("position").alias("first")))
    return placed.join(first, "conv_id").select("conv_id", (F.col("position") - F.col("first")).alias("step"), "key", "tokens")


def spliced(steps: DataFrame, period: int = 100, most: int = 6) -> DataFrame:
    """Steps of conversations rebuilt on shared beginnings: the first h steps of conversation c - c % period, then c's own after its first h.

    h is crc32(c) % most. All of the first h if there are fewer, none if that conversation is absent.
    """
    per = steps.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = per.select("conv_id", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % period).alias("base"))
    base = per.select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    led = stored(own.join(base, "base", "left").withColumn("led", F.least("h", F.coalesce("has", F.lit(0)))).drop("has"))
    heads = steps.filter((F.col("step") < most - 1) & (F.col("conv_id") % period == 0)).withColumnRenamed("conv_id", "base")
    begun = led.join(heads, "base").filter("step < led").select("conv_id", "step", "key", "tokens")
    rest = steps.join(led, "conv_id").filter("step >= h").select("conv_id", (F.col("step") - F.col("h") + F.col("led")).alias("step"), "key", "tokens")
    return begun.unionByName(rest)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each rep's ids, which are sorted, comma-joined; one id at a time."""
    rep, digest = None, None
    for batch in batches:
        out = []
        for own, conv in zip(batch.column("rep").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if own != rep:
                if digest:
                    out.append((rep, digest.hexdigest()))
                rep, digest = own, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if out:
            yield pa.record_batch([pa.array([r for r, _ in out], pa.int64()), pa.array([d for _, d in out])], ["rep", "ends_sha256"])
    if digest:
        yield pa.record_batch([pa.array([rep], pa.int64()), pa.array([digest.hexdigest()])], ["rep", "ends_sha256"])


def prefix_trie(ids: DataFrame, steps: DataFrame) -> DataFrame:
    """A row a node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ids has every conv_id, steps (conv_id, step, key, tokens) number each one's steps from 0 without gaps. A node's
    members are the conversations that begin with its steps; the root's are all, also those without steps, and its
    parent is null. Leaves and savings, (n_convs - 1) times the tokens of the last step, are sums over the node's
    subtree. ends_sha256 is of the ids of members that end there, ascending and comma-joined. Null ids are left out;
    repeated ids count once; an empty table gives no rows. Two sequences are taken for one if their lengths and 128
    bits of the hashes of their steps agree; steps by SHA-256. The ids that end at one node stream through one task,
    eight bytes each, since their hash is one; so do the steps of a chain that has copies.
    """
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id is not null").distinct()
    steps = stored(steps.select("conv_id", (F.col("step") + 1).alias("depth"), "key", "tokens"))
    hashes = [F.bit_xor(F.xxhash64(F.lit(i), "depth", "key")).alias(f"x{i}") for i in (1, 2)]
    sums = steps.groupBy("conv_id").agg(F.count("*").alias("n"), *hashes)
    shape = ["n", "x1", "x2"]
    whole = stored(every.join(sums, "conv_id", "left").select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in shape)))
    sequences = stored(whole.groupBy(*shape).agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies")))
    copied = whole.join(sequences.filter("copies > 1"), shape).select("rep", "conv_id").repartition("rep").sortWithinPartitions("rep", "conv_id")
    ends = sequences.filter("copies = 1").select("rep", F.sha2(F.col("rep").cast("string"), 256).alias("ends_sha256")).unionByName(copied.mapInArrow(_end_hashes, ENDS))

    # down: nodes of each level (depth, node, parent, n_convs, seqs, tokens), and where sequences are alone or end
    root = stored(sequences.agg(F.min("rep").alias("node"), F.sum("copies").alias("n_convs"), F.count("*").alias("seqs")).filter("seqs > 0").select("node", F.lit(None).cast("long").alias("parent"), "n_convs", "seqs", F.lit(0).cast("long").alias("tokens")))
    levels = [root]
    rows = sequences.crossJoin(F.broadcast(root.select("node", "seqs")))  # one row
    alone = [rows.filter("seqs = 1").select("rep", "n", "copies", F.lit(0).alias("level"))]
    ended = [rows.filter("n = 0 and seqs > 1").select("rep", F.lit(0).cast("long").alias("depth"), "node")]
    live = rows.filter("seqs > 1 and n > 0").select("rep", "n", "copies", F.col("node").alias("parent"))
    left = steps
    while not live.isEmpty():
        depth = len(levels)
        if depth % SPAN == 0:
            left = stored(left.join(live.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi").filter(F.col("depth") >= depth))
        at = stored(live.join(left.filter(F.col("depth") == depth), F.col("rep") == F.col("conv_id")).select("rep", "n", "copies", "parent", "key", "tokens"))
        groups = stored(at.groupBy("parent", "key").agg(F.min("rep").alias("node"), F.sum("copies").alias("n_convs"), F.count("*").alias("seqs"), F.max("tokens").alias("tokens")))
        levels.append(groups)
        placed = stored(at.join(groups.select("parent", "key", "node", "seqs"), ["parent", "key"]).select("rep", "n", "copies", "node", "seqs"))
        alone.append(placed.filter("seqs = 1").select("rep", "n", "copies", F.lit(depth).alias("level")))
        ended.append(placed.filter((F.col("seqs") > 1) & (F.col("n") == depth)).select("rep", F.lit(depth).cast("long").alias("depth"), "node"))
        live = placed.filter((F.col("seqs") > 1) & (F.col("n") > depth)).select("rep", "n", "copies", F.col("node").alias("parent"))

    union = lambda tables: tables[0] if len(tables) == 1 else union(tables[: len(tables) // 2]).unionByName(union(tables[len(tables) // 2 :]))
    lone = stored(union(alone))
    # chains below the nodes where a sequence is alone; without copies nothing is saved there
    chain = lone.join(steps, F.col("rep") == F.col("conv_id")).filter("depth > level").select("rep", "n", "copies", "depth", "tokens")
    later = F.sum("tokens").over(Window.partitionBy("rep").orderBy(F.col("depth").desc()))
    tail = chain.filter("copies = 1").withColumn("saved_tokens", F.lit(0).cast("long")).unionByName(chain.filter("copies > 1").withColumn("saved_tokens", (F.col("copies") - 1) * later))
    tail = tail.select(F.col("rep").alias("conv_id"), "depth", F.col("rep").alias("parent_conv_id"), F.col("copies").alias("n_convs"), (F.col("depth") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), "saved_tokens")
    below = stored(chain.filter("copies > 1").groupBy("rep").agg((F.max("copies") - 1).alias("times"), F.sum("tokens").alias("t")).select("rep", (F.col("times") * F.col("t")).alias("chain")))

    # up: each level's nodes with the sums of their children
    zero, done, under = F.lit(0).cast("long"), [], None
    for depth in reversed(range(len(levels))):
        nodes = levels[depth].select("node", "parent", "n_convs", "tokens")
        singles = lone.filter(F.col("level") == depth).join(below, "rep", "left").select(F.col("rep").alias("node"), (F.col("n") > depth).cast("long").alias("goes"), F.coalesce("chain", zero).alias("chain"))
        nodes = nodes.join(singles, "node", "left")
        if under is None:
            nodes = nodes.select("*", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"))
        else:
            kids = under.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            nodes = nodes.join(kids, "node", "left")
        own = (F.col("n_convs") - 1) * F.col("tokens")
        under = stored(nodes.select("node", "parent", "n_convs", F.coalesce("goes", "kids", zero).alias("n_children"), F.greatest(F.coalesce("leaves", zero), F.lit(1)).alias("n_leaves"), (own + F.coalesce("saved", zero) + F.coalesce("chain", zero)).alias("saved_tokens")))
        done.append(under.select(F.col("node").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"))

    stops = union(ended).unionByName(lone.select("rep", F.col("n").alias("depth"), F.col("rep").alias("node")))
    hashed = stops.join(ends, "rep").select(F.col("node").alias("end_id"), F.col("depth").alias("end_depth"), "ends_sha256")
    found = union([*done, tail]).join(hashed, (F.col("conv_id") == F.col("end_id")) & (F.col("depth") == F.col("end_depth")), "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
