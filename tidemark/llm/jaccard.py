"""Exact n-gram Jaccard join by set relations and block-skipped index lists.

Two sets link when ``den * |A & B| >= num * |A | B|``. The join works on distinct
sets (copies of one set share a node) and returns components, in two steps:

1. Answer level. Sets that share a minimum hash are compared with one hub each, so
   a group of m near copies costs m comparisons. A set linked with its hub takes
   over the hub's answers: both lie in one component, and only links that leave
   that component are still wanted.
2. Index level. Every set lists its prefix (the rarest shingles that a partner
   must touch) with positions. Lists whose entries all lie in one component have no
   answer left and are skipped whole. A long list is kept in blocks by size and
   position, and a probe goes only to the blocks where a partner can stand. In it
   the sets of one component are probed as one entry with their common bounds; the
   answers of its members are derived from that entry's answer.

Every pair that survives is compared on its whole texts, so the links are exact.
Bounds used before that never drop a true pair: sizes, positions, and parity
signatures (they differ in at most as many bits as the sets do in members).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, WORD, cut, small, trimmed
from .components import components
from .sets import U64, mixed, overlap, parity, shingle_sets

BUCKETS = 1 << 14
MINIMA = 4
#: Blocks of a long list: sizes by this share of the ratio that can still link, prefixes by this many places.
SIZES, PLACES = 2, 4
SIGNATURE = 16  # longs
SEEDS = np.array([0x51ED270B, 0x2545F491, 0x7FEB352D, 0x846CA68B], dtype=U64)

ROWS = "kind int, doc_id long, n long, s1 long, s2 long, minima array<long>, sig array<long>, fine array<long>"


@dataclass(frozen=True)
class Likeness:
    """Shingle length and threshold ``num / den``."""

    k: int = 3
    num: int = 9
    den: int = 10

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def sizes(self, a: Column, b: Column) -> Column:
        return self.den * F.least(a, b) >= self.num * F.greatest(a, b)

    def bits(self, a: Column, b: Column, apart: Column) -> Column:
        """``apart``: bits in which two parity signatures differ."""
        return (self.den + self.num) * apart <= (self.den - self.num) * (a + b)

    def positions(self, a: Column, b: Column, left_a: Column, left_b: Column) -> Column:
        """``left``: members from the common one on."""
        return (self.den + self.num) * F.least(left_a, left_b) >= self.num * (a + b)

    def block(self, n: Column) -> Column:
        """Sizes that can link lie at most SIZES blocks apart."""
        return F.floor(SIZES * F.log(n.cast("double")) / float(np.log(self.den / self.num)) + 1e-9).cast("int")

    def place(self, n: Column, pos: Column) -> Column:
        return F.floor(PLACES * pos / (n - F.ceil(self.num * n / self.den) + 1)).cast("int")

    def reachable(self, n: Column, block: Column, place: Column) -> Column:
        """Whether a set of at least ``n`` members can have a larger partner in that block of a list."""
        most = F.pow(F.lit((self.den / self.num) ** (1 / SIZES)), block + 1)
        left = most * (1 - place / PLACES * ((self.den - self.num) / self.den))
        return (self.den + self.num) * left + 1e-3 >= self.num * (n + most)

    def linked(self, both: int, a: int, b: int) -> bool:
        return self.den * both >= self.num * (a + b - both)


def _bucket(s: np.ndarray) -> np.ndarray:
    return ((s >> U64(40)) & U64(BUCKETS - 1)).astype(np.int64)


def _digest(s: np.ndarray) -> np.ndarray:
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype="<i8")


def _fine(s: np.ndarray) -> np.ndarray | None:
    """A signature of at least a bit a member (a power of two) where the usual one has less: it would tell large sets apart no more."""
    longs = (1 << (len(s) - 1).bit_length()) // 64
    return parity(s, longs) if longs > SIGNATURE else None


def _describe(docs: DataFrame, like: Likeness) -> DataFrame:
    """kind 0: a row for each document; kind 1: this task's shingles by bucket, in ``sig``."""

    def run(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in ROWS.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 3]
        total = np.zeros(BUCKETS, dtype=np.int64)
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), []
            for i, s in shingle_sets(batch.column(1), like.k):
                if not len(s):
                    rows.append((0, doc_ids[i], 0, None, None, None, None, None))
                else:
                    total += np.bincount(_bucket(s), minlength=BUCKETS)
                    minima = [int(mixed(s ^ seed).min().view(np.int64)) for seed in SEEDS]
                    rows.append((0, doc_ids[i], len(s), *_digest(s).tolist(), minima, parity(s, SIGNATURE), _fine(s)))
                if len(rows) == 512:
                    yield pack(rows)
                    rows = []
            if rows:
                yield pack(rows)
        if total.any():
            yield pack([(1, None, None, None, None, None, total, None)])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), ROWS)


def _bucket_counts(rows: DataFrame) -> np.ndarray:
    """The tasks' counts by bucket, added up; at most BUCKETS rows come to the driver."""
    found = rows.filter("kind = 1").select(F.posexplode("sig").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n")).collect()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in found:
        counts[bucket] = n
    return counts


def _verify(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, like: Likeness, broadcast_bytes: int, per_task: int = 256) -> DataFrame:
    """The ``pairs`` (a, b: nodes) that link, by their whole texts.

    The text of a goes once to each share of at most about ``per_task`` partners.
    """
    crowded = pairs.groupBy("a").count().filter(F.col("count") > per_task)
    crowded = small(cut(crowded.select("a", F.ceil(F.col("count") / per_task).alias("shares")), "crowded-hubs"), broadcast_bytes)
    salted = pairs.join(crowded, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("shares", F.lit(1))).cast("int"))
    hubs = salted.select(F.col("a").alias("node"), "a", "salt", F.lit(0).alias("role")).distinct()
    members = salted.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role"))
    roles = small(cut(hubs.unionByName(members), "pair-nodes"), broadcast_bytes)
    roles = nodes.select("node", F.col("rep").alias("doc_id"), "s1").join(roles, "node")
    roles = small(cut(roles, "pair-roles"), broadcast_bytes)
    texts = docs.select("doc_id", "text").join(roles, "doc_id")
    texts = texts.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").select("a", "salt", "role", "node", "s1", "text")

    def run(batches):
        import pyarrow as pa

        hub, at = None, None
        for batch in batches:
            rows, a, b = list(zip(*(batch.column(i).to_pylist() for i in range(5)))), [], []
            for i, s in shingle_sets(batch.column(5), like.k):
                g, salt, role, node, s1 = rows[i]
                if not len(s) or int(_digest(s)[0]) != s1:  # another row under the same doc_id
                    continue
                if role == 0:
                    hub, at = s, (g, salt)
                elif at == (g, salt) and like.linked(overlap(hub, s), len(hub), len(s)):
                    a.append(g)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return texts.mapInArrow(trimmed(run), "a long, b long").distinct()


def _folded(nodes: DataFrame) -> DataFrame:
    """f1, f2: the signature folded to 128 bits, which keeps its bound and is light enough for index entries."""
    fold = "aggregate(slice(sig, {}, {}), 0L, (t, x) -> t ^ x)"
    half = SIGNATURE // 2
    return nodes.withColumns({"f1": F.expr(fold.format(1, half)), "f2": F.expr(fold.format(half + 1, half))})


def _folds_apart(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def _of_longs(sig: Column, longs: Column) -> Column:
    """A signature folded to so many longs, a power of two no larger than its own; the bound stays."""
    fold = lambda i: F.aggregate(F.sequence(F.lit(0), (F.size(sig) / longs).cast("int") - 1), F.lit(0).cast("long"), lambda t, j: t.bitwiseXOR(F.get(sig, i + j * longs)))
    return F.when(F.size(sig) == longs, sig).otherwise(F.transform(F.sequence(F.lit(0), longs - 1), fold))


def _by_signature(pairs: DataFrame, nodes: DataFrame, like: Likeness, broadcast_bytes: int) -> DataFrame:
    """The distinct ``pairs`` whose whole signatures allow a link; only sets in a pair bring theirs."""
    pairs = cut(pairs.distinct(), "folded-pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    signed = nodes.select("node", "n", F.coalesce("fine", "sig").alias("sig")).join(small(cut(ends, "pair-ends"), broadcast_bytes), "node", "left_semi")
    a, b = (signed.withColumnsRenamed({"node": x, "n": f"{x}_n", "sig": f"{x}_sig"}) for x in "ab")
    met = pairs.join(a, "a").join(b, "b")
    longs = F.least(F.size("a_sig"), F.size("b_sig"))
    apart = F.zip_with(_of_longs(F.col("a_sig"), longs), _of_longs(F.col("b_sig"), longs), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(apart, F.lit(0), lambda t, x: t + x)
    return met.filter(like.bits(F.col("a_n"), F.col("b_n"), apart)).select("a", "b")


def _stars(nodes: DataFrame, like: Likeness, broadcast_bytes: int) -> DataFrame:
    """Pairs of each set with the hub of each of its minima: at most MINIMA a set."""
    entries = _folded(nodes).select("node", "rep", "n", "f1", "f2", F.posexplode("minima").alias("i", "least"))
    hubs = entries.groupBy("i", "least").agg(F.min(F.struct("rep", "node", "n", "f1", "f2")).alias("hub"), F.count("*").alias("size")).filter("size > 1")
    hubs = hubs.select("i", "least", *(F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "n", "f1", "f2")))
    pairs = entries.join(small(cut(hubs, "hubs"), broadcast_bytes), ["i", "least"]).filter("node <> hub_node")
    apart = _folds_apart(*map(F.col, ("f1", "f2", "hub_f1", "hub_f2")))
    pairs = pairs.filter(like.sizes(F.col("n"), F.col("hub_n")) & like.bits(F.col("n"), F.col("hub_n"), apart))
    return pairs.select(F.col("hub_node").alias("a"), F.col("node").alias("b"))


def _prefixes(docs: DataFrame, counts, like: Likeness) -> DataFrame:
    """Index entries: token, doc_id, s1, n, pos; rare buckets first, so the order is one for all sets."""

    def run(batches):
        import pyarrow as pa

        order = counts.value
        for batch in batches:
            doc_ids, out = batch.column(0).to_pylist(), []
            pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["token", "doc_id", "s1", "n", "pos"])
            for i, s in shingle_sets(batch.column(1), like.k):
                if not len(s):
                    continue
                p = like.prefix(len(s))
                rare, ranks = s, order[_bucket(s)]
                if 4 * p < len(s):  # those beyond the p-th rank (ties stay) can't be in the prefix
                    near = ranks <= np.partition(ranks, p - 1)[p - 1]
                    rare, ranks = s[near], ranks[near]
                first = rare[np.lexsort((rare, ranks))[:p]]
                out.append((first.view(np.int64), np.full(p, doc_ids[i]), np.full(p, _digest(s)[0]), np.full(p, len(s)), np.arange(p)))
                if len(out) == 256:
                    yield pack(out)
                    out = []
            if out:
                yield pack(out)

    docs = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return docs.mapInArrow(trimmed(run), "token long, doc_id long, s1 long, n long, pos long")


SIDE = ("node", "n", "pos", "component", "f1", "f2")


def _pairs(met: DataFrame, like: Likeness) -> DataFrame:
    """Of rows with both sides' fields (a_ and b_) the pairs that sizes, positions and folds allow, smaller set first."""
    met = met.filter("a_component <> b_component AND (a_n < b_n OR (a_n = b_n AND a_node < b_node))")
    a_n, b_n, a_pos, b_pos = map(F.col, ("a_n", "b_n", "a_pos", "b_pos"))
    met = met.filter(like.sizes(a_n, b_n) & like.positions(a_n, b_n, a_n - a_pos, b_n - b_pos))
    met = met.filter(like.bits(a_n, b_n, _folds_apart(*map(F.col, ("a_f1", "a_f2", "b_f1", "b_f2")))))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _signed(groups: DataFrame, nodes: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Entries of long lists with the whole signature of those that are one set."""
    sole = small(cut(groups.filter("sole IS NOT NULL").select(F.col("sole").alias("node")).distinct(), "sole-nodes"), broadcast_bytes)
    signed = cut(nodes.select("node", "sig").join(sole, "node", "left_semi"), "sole-signatures").withColumnRenamed("node", "sole")
    return groups.join(small(signed, broadcast_bytes), "sole", "left").drop("sole")


def _long_lists(lists: DataFrame, nodes: DataFrame, like: Likeness, broadcast_bytes: int) -> DataFrame:
    """Pairs of long lists: blocks by size and position, components as single entries, members derived."""
    blocked = lists.withColumns({"block": like.block(F.col("n")), "place": like.place(F.col("n"), F.col("pos"))})
    key = ["token", "block", "place", "component"]
    folds = {f"{how.__name__}_{f}": how(f) for f in ("f1", "f2") for how in (F.bit_and, F.bit_or)}
    sole = F.when(F.count("*") == 1, F.min("node")).alias("sole")  # an entry of one set brings its whole signature
    ends = [F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("node").alias("first"), F.max("node").alias("last")]
    groups = blocked.groupBy(*key).agg(*ends, F.max(F.col("n") - F.col("pos")).alias("left"), sole, *(c.alias(name) for name, c in folds.items()))
    groups = _signed(cut(groups, "list-groups"), nodes, broadcast_bytes)
    a = groups.withColumnsRenamed({c: f"a_{c}" for c in groups.columns if c != "token"})
    blocks = F.explode(F.sequence(F.col("a_block"), F.col("a_block") + SIZES)).alias("block")
    a = a.select("*", blocks).select("*", F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))).alias("place"))
    a = a.filter(like.reachable(F.col("a_lo"), F.col("block"), F.col("place")))
    # the side that is called a brings the smaller set of a pair, in the order of _pairs
    smaller = (F.col("a_lo") < F.col("hi")) | ((F.col("a_lo") == F.col("hi")) & (F.col("a_first") < F.col("last")))
    met = a.join(groups, ["token", "block", "place"]).filter("a_component <> component").filter(smaller)
    met = met.filter(like.den * F.least("a_hi", "hi") >= like.num * F.greatest("a_lo", "lo"))
    met = met.filter(like.positions(F.col("a_lo"), F.col("lo"), F.col("a_left"), F.col("left")))
    # bits that all sets of one entry have and none of the other's differ in every pair of their members
    only = lambda x, y, f: F.bit_count(F.col(f"{x}bit_and_{f}").bitwiseAND(F.bitwise_not(f"{y}bit_or_{f}")))
    apart = sum((only(x, y, f) for x, y in (("a_", ""), ("", "a_")) for f in ("f1", "f2")), F.lit(0))
    met = met.filter(like.bits(F.col("a_hi"), F.col("hi"), apart))
    whole = F.aggregate(F.zip_with("a_sig", "sig", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    met = met.filter(F.coalesce(like.bits(F.col("a_hi"), F.col("hi"), whole), F.lit(True)))
    met = met.select("token", "a_block", "a_place", "a_component", *(F.col(c).alias(f"b_{c}") for c in key[1:]))
    for side in "ab":
        members = blocked.select("token", *(F.col(c).alias(f"{side}_{c}") for c in (*key[1:3], *SIDE)))
        met = met.join(members, ["token", *(f"{side}_{c}" for c in key[1:])])
    return _pairs(met, like)


def _candidates(entries: DataFrame, nodes: DataFrame, like: Likeness, broadcast_bytes: int, long_list: int = 64) -> DataFrame:
    """Pairs of sets of different components that one index list can't rule out."""
    of_list, by_size = Window.partitionBy("token"), Window.partitionBy("token").orderBy("n", "node")
    # most lists are ruled out here, after the only shuffle of all entries; repeated rows go after that
    alive = entries.withColumns({"lo": F.min("component").over(of_list), "hi": F.max("component").over(of_list)}).filter("lo <> hi")
    alive = alive.dropDuplicates(["token", "node"])
    alive = alive.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size), "many": F.count("*").over(of_list)})
    # an entry whose neighbours by size in its list can't match has no answer there
    alive = alive.filter(like.sizes(F.col("n"), F.col("below")) | like.sizes(F.col("n"), F.col("above")))
    alive = cut(alive.drop("lo", "hi", "below", "above"), "index-lists")
    folds = small(cut(_folded(nodes).select("node", "f1", "f2"), "folds"), broadcast_bytes)
    alive = alive.join(folds, "node")
    short, long = alive.filter(F.col("many") <= long_list), alive.filter(F.col("many") > long_list)
    a, b = (short.select("token", *(F.col(c).alias(f"{side}_{c}") for c in SIDE)) for side in "ab")
    return _pairs(a.join(b, "token"), like).unionByName(_long_lists(long, nodes, like, broadcast_bytes))


def jaccard_groups(docs: DataFrame, like: Likeness = Likeness(), broadcast_bytes: int = BROADCAST_BYTES, long_list: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), a row for each row.

    Null, empty and wordless texts have the empty set and link with nothing; a null
    doc_id takes no part in links and keeps a null component. Rows of one doc_id
    with different texts are different sets of one component. Texts are read whole,
    however long; other columns are not read. An empty table gives none.
    """
    spark = docs.sparkSession
    rows = cut(_describe(docs, like), "sets")
    counts = _bucket_counts(rows)
    sets = rows.filter("kind = 0").drop("kind")
    nodes = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("minima").alias("minima"), F.first("sig").alias("sig"), F.first("fine").alias("fine")
    )
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "set-nodes")

    stars = cut(_by_signature(_stars(nodes, like, broadcast_bytes), nodes, like, broadcast_bytes), "star-pairs")
    links = cut(_verify(docs, stars, nodes, like, broadcast_bytes), "star-links")
    # rows of one doc_id are one document, so their sets are linked by it
    of_doc = sets.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "s1", "s2").distinct()
    twice = of_doc.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    twice = of_doc.join(twice, "doc_id").join(nodes.select("s1", "s2", "node"), ["s1", "s2"])
    twice = twice.join(twice.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))
    near = cut(components(links.unionByName(twice)), "star-components")
    held = nodes.select("rep", "s1", "node").join(near.withColumnRenamed("id", "node"), "node", "left")
    held = cut(held.select(F.col("rep").alias("doc_id"), "s1", "node", F.coalesce("component", "node").alias("component")), "set-components")

    shared = spark.sparkContext.broadcast(counts)
    entries = _prefixes(docs, shared, like).join(small(held, broadcast_bytes), ["doc_id", "s1"]).drop("doc_id", "s1")
    pairs = cut(_by_signature(_candidates(entries, nodes, like, broadcast_bytes, long_list), nodes, like, broadcast_bytes), "candidate-pairs")
    links = _verify(docs, pairs, nodes, like, broadcast_bytes)
    of = held.select("node", "component")
    links = links.join(of.withColumnsRenamed({"node": "a", "component": "ca"}), "a").join(of.withColumnsRenamed({"node": "b", "component": "cb"}), "b")
    last = cut(components(cut(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "candidate-links")), "component-merges")

    label = held.select("node", "component").join(last.select(F.col("id").alias("component"), F.col("component").alias("merged")), "component", "left")
    label = nodes.select("node", "s1", "s2", "rep").join(label.select("node", F.coalesce("merged", "component").alias("component")), "node")
    label = cut(label.select("s1", "s2", "rep", "component"), "node-labels")
    named = label.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = small(cut(label.join(named, "component").select("s1", "s2", "component_id"), "set-labels"), broadcast_bytes)
    out = sets.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2").join(label, ["s1", "s2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, like: Likeness = Likeness(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Of each component the row of the smallest doc_id; null doc_ids and documents without words stay.

    Where that doc_id has several rows, one of them stays: that of the smallest hash of its text.
    """
    groups = cut(jaccard_groups(docs, like, broadcast_bytes), "groups")
    gone = cut(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "near-duplicates")
    kept = docs.join(small(gone, broadcast_bytes), "doc_id", "left_anti").select(docs.columns)
    again = groups.filter("component_id = doc_id AND n_shingles > 0").groupBy("doc_id").count().filter("count > 1")
    again = cut(again.select("doc_id"), "repeated-ids")
    if not again.count():
        return kept
    again = small(again, broadcast_bytes)
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    repeated = kept.join(again, "doc_id", "left_semi").select(docs.columns)
    one = repeated.filter(worded).select("doc_id", F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("h"), "text")
    one = one.groupBy("doc_id").agg(F.min_by("row", F.struct("h", "text")).alias("row")).select("row.*")
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one).unionByName(repeated.filter(~worded))
