"""Prefix trie of conversations by partition refinement.

All conversations start in one class. In every round each active class is split by
its members' next turn. A class of one member retires, and so does one whose members
go on alike to their ends: what is left of it is a chain without branches, which its
smallest member's turns give at the end. Then the active classes are folded back,
deepest first. Rounds end with the deepest class that still branches, however long
the chains are.

A turn is known by 128 bits of its role and text, a class by its hash over its turns, so
no text is shuffled; a conversation is never held as one group, and a conversation, a turn
or a class may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, small, trimmed

#: Bytes of decimal conv_ids that are joined before they meet in one hash.
CHUNK = 1 << 16


def _hash(seed: int, *cols: str | Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, k1, k2, bytes, before: each conversation's turns in order, and the bytes of text before each.

    Order: turn (null first), then the turn's hash. A conversation may span
    partitions of the sorted rows: positions count within one, and the sums of the earlier ones are added.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _hash(1, role, text).alias("k1"), _hash(2, role, text).alias("k2"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), "k1", "k2", "tie"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "conv_id", *order).withColumn("part", F.spark_partition_id())
    w = Window.partitionBy("conv_id", "part").orderBy(*order)
    pos, before = F.row_number().over(w) - 1, F.sum("bytes").over(w) - F.col("bytes")
    rows = cut(rows.select("conv_id", "part", pos.cast("long").alias("pos"), "k1", "k2", "bytes", before.alias("before")), "turns")
    # a conversation has a row here for each partition it spans, one as a rule
    spans = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.select("conv_id", "part", F.sum("n").over(earlier).alias("n"), F.sum("b").over(earlier).alias("b")).filter("n IS NOT NULL")
    # only a partition's first conversation can have begun before it
    shifts = F.broadcast(cut(shifts, "turn-shifts"))
    moved = rows.join(shifts, ["conv_id", "part"], "left")
    add = lambda c, s: (F.col(c) + F.coalesce(F.col(s), F.lit(0))).alias(c)
    return moved.select("conv_id", add("pos", "n"), "k1", "k2", "bytes", add("before", "b"))


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each has taken the first turns of its family's first one.

    Conversation c takes the first h = crc32(decimal c) % most turns of c - c % family and keeps its own from
    the h-th on (c % family has the sign of c). conversations: conv_id, length, rest1, rest2 (hashes over all turns); turns: conv_id, pos, k1,
    k2, bytes, behind (bytes of this turn and all after it).
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % family
    size = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    convs = size.select("conv_id", "n", "b", h.alias("h"), base.alias("base"))
    head = turns.filter(F.col("pos") < most)
    lent = head.select(F.col("conv_id").alias("base"), F.col("pos").alias("at"), "k1", "k2", "bytes")
    lent = convs.join(lent, "base").filter("at < h")
    # at most ``most`` - 1 turns are taken by each conversation
    taken = lent.groupBy("conv_id").agg(F.count("*").alias("m"), F.sum("bytes").alias("mb"))
    skipped = head.join(convs.select("conv_id", "h"), "conv_id").filter("pos < h").groupBy("conv_id").agg(F.sum("bytes").alias("sb"))
    facts = convs.join(taken, "conv_id", "left").join(skipped, "conv_id", "left")
    facts = facts.select("conv_id", "h", "b", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("m", "mb", "sb")), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    facts = cut(facts, "trie-conversations")

    back = Window.partitionBy("conv_id").orderBy(F.desc("at"))  # under ``most`` rows
    first = lent.select("conv_id", "at", "k1", "k2", "bytes", F.sum("bytes").over(back).alias("lent")).join(facts, "conv_id")
    first = first.select("conv_id", F.col("at").alias("pos"), "k1", "k2", "bytes", (F.col("lent") + F.col("b") - F.col("sb")).alias("behind"))
    own = turns.join(facts, "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "k1", "k2", "bytes", (F.col("b") - F.col("before")).alias("behind"))
    out = cut(first.unionByName(own).withColumn("level", F.least("pos", F.lit(16)).cast("int")), "trie-turns", "level")
    rests = out.groupBy("conv_id").agg(*(F.bit_xor(r).alias(f"rest{i}") for i, r in enumerate(_rests(), 1)))
    facts = facts.select("conv_id", (F.col("m") + F.col("own")).alias("length")).join(rests, "conv_id", "left")
    return facts.select("conv_id", "length", *(F.coalesce(f"rest{i}", F.lit(0)).alias(f"rest{i}") for i in (1, 2))), out


def _rests() -> list[Column]:
    """What a turn at its place adds to its conversation's hash of all turns from there on."""
    return [_hash(3 + i, "pos", "k1", "k2") for i in (0, 1)]


@dataclass
class Refinement:
    """classes: one row each, by depth; ends: members of classes of several that end in a node."""

    classes: list[DataFrame]
    ends: list[DataFrame]


CLASS = "c1 long, c2 long, parent1 long, parent2 long, conv_id long, parent_conv_id long, depth int, n_convs long, bytes long, behind long, chain boolean"


def refine(convs: DataFrame, turns: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Refinement:
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    none = F.lit(None).cast("long")
    root = root.select(F.lit(0).cast("long").alias("c1"), F.lit(0).cast("long").alias("c2"), none.alias("parent1"), none.alias("parent2"), "conv_id", none.alias("parent_conv_id"), F.lit(0).alias("depth"), "n_convs", F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("behind"), F.lit(False).alias("chain"))
    classes, ends = [cut(root, "class-0")], []
    smallest = classes[0].select("conv_id").first()
    if smallest is None:
        return Refinement(classes, ends)
    zero = F.lit(0).cast("long")
    active = cut(convs.select("conv_id", "length", zero.alias("c1"), zero.alias("c2"), F.lit(smallest[0]).alias("top"), "rest1", "rest2"), "active-0")
    depth = 0
    while not active.isEmpty():
        ends.append(active.filter(F.col("length") == depth).select(F.col("top").alias("node_id"), F.lit(depth).cast("long").alias("depth"), "conv_id"))
        turn = turns.filter((F.col("level") == min(depth, 16)) & (F.col("pos") == depth)).select("conv_id", "pos", "k1", "k2", "bytes", "behind")
        split = active.join(turn, "conv_id")
        rests = [F.col(f"rest{i}").bitwiseXOR(r).alias(f"rest{i}") for i, r in enumerate(_rests(), 1)]
        split = split.select("conv_id", "length", "top", *(_hash(s, "c1", "c2", "k1", "k2").alias(f"n{s - 4}") for s in (5, 6)), F.col("c1").alias("p1"), F.col("c2").alias("p2"), "bytes", "behind", *rests)
        split = cut(split, f"split-{depth}")
        alike = (F.min("rest1") == F.max("rest1")) & (F.min("rest2") == F.max("rest2"))
        new = split.groupBy("n1", "n2").agg(F.min("p1").alias("parent1"), F.min("p2").alias("parent2"), F.min("conv_id").alias("least"), F.min("top").alias("parent_conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.max("behind").alias("behind"), alike.alias("chain"))
        depth += 1
        new = cut(new.select(F.col("n1").alias("c1"), F.col("n2").alias("c2"), "parent1", "parent2", F.col("least").alias("conv_id"), "parent_conv_id", F.lit(depth).alias("depth"), "n_convs", "bytes", "behind", "chain"), f"class-{depth}")
        classes.append(new)
        many = new.filter("n_convs > 1").select(F.col("c1").alias("n1"), F.col("c2").alias("n2"), F.col("conv_id").alias("least"), "chain")
        members = split.select("conv_id", "length", "n1", "n2", "rest1", "rest2").join(small(cut(many, f"many-{depth}"), broadcast_bytes), ["n1", "n2"])
        members = cut(members, f"members-{depth}")
        ends.append(members.filter("chain").select(F.col("least").alias("node_id"), F.col("length").alias("depth"), "conv_id"))
        active = members.filter(~F.col("chain")).select("conv_id", "length", F.col("n1").alias("c1"), F.col("n2").alias("c2"), F.col("least").alias("top"), "rest1", "rest2")
    return Refinement(classes, ends)


def fold_back(classes: list[DataFrame]) -> DataFrame:
    """The active classes with their children and the sums over their subtrees; the deepest are folded first."""
    below, out = None, []
    for rows in reversed(classes):
        own = (F.col("n_convs") - 1) * F.col("bytes")
        folded = rows.filter(~F.col("chain"))
        if below is None:
            folded = folded.withColumns({"n_children": F.lit(0).cast("long"), "n_leaves": F.lit(1).cast("long"), "saved_tokens": own})
        else:
            sums = below.groupBy("parent1", "parent2").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("_saved"))
            folded = folded.join(sums.select(F.col("parent1").alias("c1"), F.col("parent2").alias("c2"), "n_children", "n_leaves", "_saved"), ["c1", "c2"], "left")
            folded = folded.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "n_leaves": F.coalesce("n_leaves", F.lit(1)), "saved_tokens": own + F.coalesce("_saved", F.lit(0))})
        folded = cut(folded.select("parent1", "parent2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "folded")
        out.append(folded)
        chains = rows.filter("chain").select("parent1", "parent2", F.lit(1).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("behind")).alias("saved_tokens"))
        below = folded.select("parent1", "parent2", "n_leaves", "saved_tokens").unionByName(chains)
    nodes = out[0]
    for folded in out[1:]:
        nodes = nodes.unionByName(folded)
    return nodes.drop("parent1", "parent2")


def _id_chunks(batches):
    """Of rows sorted by (node_id, depth, conv_id): the ids of each node joined by commas, in chunks."""
    import pyarrow as pa

    schema = pa.schema([("node_id", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("ids", pa.binary())])
    node, first, held, size = None, None, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if node is not None and (row[:2] != node or size >= CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*node, first, b",".join(held)), schema.types)], schema=schema)
                held, size = [], 0
            if not held:
                node, first = row[:2], row[2]
            held.append(str(row[2]).encode())
            size += len(held[-1]) + 1
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*node, first, b",".join(held)), schema.types)], schema=schema)


def _digests(batches):
    """Of chunks sorted by (node_id, depth, conv_id): SHA-256 of each node's chunks joined by commas, one chunk at a time."""
    import hashlib

    import pyarrow as pa

    schema = pa.schema([("node_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.string())])
    node, state, done = None, None, []

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
        done.clear()
        return out

    for batch in batches:
        for node_id, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (node_id, depth) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (node_id, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids)
            if len(done) >= 4096:
                yield flush()
    if node is not None:
        done.append((*node, state.hexdigest()))
    if done:
        yield flush()


def end_digests(ends: DataFrame) -> DataFrame:
    """node_id, depth, digest: SHA-256 over the ascending ids that end in a node.

    SHA-256 reads its input in one piece, so a node's ids meet in one task; they come as chunks of
    64 KB that even tasks have joined before, and pass through it one after the other.
    """
    key = ["node_id", "depth", "conv_id"]
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ends.select(*key).repartitionByRange(n, *key).sortWithinPartitions(*key).mapInArrow(trimmed(_id_chunks), "node_id long, depth long, conv_id long, ids binary")
    return chunks.repartition(n, "node_id", "depth").sortWithinPartitions(*key).mapInArrow(trimmed(_digests), "node_id long, depth long, digest string")


def prefix_trie(conversations: DataFrame, family: int = 5, most: int = 9, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations (see ``rebuilt``).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over
    the subtree, the node included), ends_sha256. Null role and text are empty, a null turn comes first,
    turns alike in number are ordered by the hash of role and text; repeated rows are turns of their own.
    Rows with a null conv_id belong to no conversation and are left out. Other columns are
    not read. Texts are taken whole. A conversation without turns after the rebuilding is a member of
    the root only. An empty table gives no rows.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    convs, turns = rebuilt(cut(numbered(conversations), "numbered"), family, most)
    convs = cut(convs, "trie-members")
    found = refine(convs, turns, broadcast_bytes)
    nodes = fold_back(found.classes)

    chains = None
    for rows in found.classes:
        part = rows.filter("chain").select(F.col("conv_id").alias("node_id"), F.col("depth").cast("long").alias("from"), "n_convs", F.col("parent_conv_id").alias("above"))
        chains = part if chains is None else chains.unionByName(part)
    chains = cut(chains, "chains").join(convs.select(F.col("conv_id").alias("node_id"), "length"), "node_id")
    depth = F.col("pos") + 1
    tails = turns.join(chains, F.col("conv_id") == F.col("node_id")).filter(depth >= F.col("from"))
    tails = tails.select(
        "conv_id", depth.alias("depth"), F.when(depth == F.col("from"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        (depth < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("behind")).alias("saved_tokens"),
        F.when((depth == F.col("length")) & (F.col("n_convs") == 1), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).alias("single"),
    )
    nodes = nodes.withColumns({"depth": F.col("depth").cast("long"), "single": F.lit(None).cast("string")}).unionByName(tails)
    if not found.ends:
        return nodes.withColumn("ends_sha256", F.sha2(F.lit(b""), 256)).drop("single")
    ends = found.ends[0]
    for rows in found.ends[1:]:
        ends = ends.unionByName(rows)
    digests = cut(end_digests(ends), "end-digests").withColumnRenamed("node_id", "conv_id")
    nodes = nodes.join(digests, ["conv_id", "depth"], "left")
    return nodes.withColumn("ends_sha256", F.coalesce("digest", "single", F.sha2(F.lit(b""), 256))).drop("digest", "single")
