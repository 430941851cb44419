"""Documents with nearly the same word shingles, by signature trees.

A document is the set of its shingles. Two link when 100 * intersection >= percent * union, exactly.

1. Equal sets are one; the smallest doc_id stands for them.
2. Which pairs can link at all? With the shingles of all documents in one fixed order, two sets that link share a
   shingle among the first few of each, and e + 1 of them if each looks e further. So each set may then forget the e most
   frequent of its shingles and still share one. What remains are rare shingles; common passages do not gather documents.
3. Documents that share such a shingle stand in one tree; shingles with the same documents share theirs. First each is compared with one other that it shares most
   with, so that groups of near copies become components without comparing all with all.
4. Documents that still stand in a tree with others of another component look at their whole sets, in the order of how many
   of these documents have a shingle. Two sets that link share a shingle among the rarest n - ceil(percent n) + 1 of each,
   so a passage gathers only documents of which it makes up nearly all.
5. Each such shingle whose documents lie in several components gets a signature tree: its leaves are documents, ordered by
   component and size; nodes hold the OR of the bitmaps of what is below, and ranges of size, of component and of what
   bitmaps hide. Two trees are walked at once from the top. A pair of nodes is left when it lies in one component, when
   its sizes cannot fit, or when the common bits cannot carry the overlap that the smallest sizes need. A large tree is cut
   into blocks, and whole blocks are paired by the same bound before any document is sent.
6. Pairs of documents that remain are compared by whole sets.

Shingles are compared by 64-bit hashes; sets are equal if their size and two 64-bit sums over them are.

Defined results: null texts and texts without words have no shingles and link with nothing; a text with fewer words than
a shingle is one shingle; a null doc_id links with nothing and its component is null; rows that repeat a doc_id are one
node, whose links are those of all its texts; an empty table gives no rows; other columns are ignored by ``join`` and
kept by ``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.llm.components import smallest_reachable
from panelkit.sources.staging import stage


@dataclass(frozen=True)
class Shingles:
    """Words in a shingle, least percent of the union; how much further sets look; bits of a signature; size of a block; fan."""

    size: int = 4
    percent: int = 85
    further: float = 0.25
    bits: int = 2048
    block: int = 256
    fan: int = 16

    def look(self, n: np.ndarray) -> np.ndarray:
        """How many of n shingles, in order, to look at. Two sets that link share one among the first n - ceil(percent n) + 1."""
        first = n - -(-self.percent * n // 100) + 1
        return np.where(n > 0, np.minimum(n, first + np.ceil(self.further * first).astype(np.int64)), 0)

    def forget(self, n: np.ndarray) -> np.ndarray:
        """How many shared ones may be forgotten: what the smallest set that can link with n shingles looks further."""
        least = -(-self.percent * n // 100)
        return np.where(n > 0, self.look(least) - (least - -(-self.percent * least // 100) + 1), 0)


def shingled(texts: pa.Array, how: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text in rising order, one text after the other, and their numbers."""
    words = common.Words(texts, lower=True)
    hashes = words.hashes()
    found, counts = common.windows(words, hashes, how.size)
    owner = np.repeat(np.arange(len(counts)), counts)
    few = np.flatnonzero((words.counts > 0) & (words.counts < how.size))
    if len(few):
        place = common.ragged(np.zeros(len(words.counts)), words.counts).astype(np.uint64)
        whole = common.by_text(common.mixed(hashes + common.mixed(place + np.uint64(1))), words.counts, np.add)
        found, owner = np.concatenate([found, common.mixed(whole[few])]), np.concatenate([owner, few])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    fresh = np.ones(len(found), dtype=bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[fresh], np.bincount(owner[fresh], minlength=len(counts))


def set_hashes(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = common.by_text(common.mixed(found + np.uint64(0x9E3779B97F4A7C15)), counts, np.add)
    return a, common.by_text(common.mixed(found ^ np.uint64(0xC2B2AE3D27D4EB4F)), counts, np.add)


def first_scan(docs: DataFrame, how: Shingles) -> DataFrame:
    """Per row: doc, number of shingles, two hashes of the set, how many keys to forget, and the keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            found, counts = shingled(batch.column("text"), how)
            a, b = set_hashes(found, counts)
            look, forget = how.look(counts), how.forget(counts)
            keys = found[common.ragged(np.cumsum(counts) - counts, look)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(counts), pa.array(common.signed(a)), pa.array(common.signed(b)), pa.array(forget), common.list_array(pa.array(common.signed(keys)), look)],
                ["doc", "n", "a", "b", "forget", "keys"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    return rows.mapInArrow(scan, "doc long, n long, a long, b long, forget long, keys array<long>")


SETS = "doc long, n long, shingles binary, bits binary"


def second_scan(docs: DataFrame, wanted: DataFrame, how: Shingles) -> DataFrame:
    """Whole sets and signatures of the documents wanted (doc, a, b)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            found, counts = shingled(batch.column("text"), how)
            a, b = set_hashes(found, counts)
            right = (common.signed(a) == batch.column("a").to_numpy()) & (common.signed(b) == batch.column("b").to_numpy())
            stops = np.cumsum(counts)
            rows = []
            for k in np.flatnonzero(right):
                own = found[stops[k] - counts[k] : stops[k]]
                bits = np.zeros(how.bits, dtype=np.uint8)
                bits[(common.mixed(own) % np.uint64(how.bits)).astype(np.int64)] = 1
                rows.append((batch.column("doc")[k].as_py(), len(own), own.tobytes(), np.packbits(bits).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["doc", "n", "shingles", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(wanted, "doc")
    return rows.select("doc", "a", "b", "text").mapInArrow(scan, SETS)


def plausible(pairs: DataFrame, sets: DataFrame, how: Shingles) -> DataFrame:
    """The pairs (x, y) that sizes and signatures cannot rule out; whole sets are sent for these alone."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = np.zeros(batch.num_rows, np.int64)
            p, q = (Level.leaves(_words(batch.column(f"bits_{s}")), batch.column(f"n_{s}").to_numpy(), none + k) for k, s in enumerate("xy"))
            at = np.arange(batch.num_rows)
            yield batch.select(["x", "y"]).filter(pa.array(may_link(p, q, at, at, how.percent)))

    own = sets.select("doc", "n", "bits")
    for side in "xy":
        pairs = pairs.join(own.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    return pairs.mapInArrow(prune, "x long, y long").distinct()


def compared(pairs: DataFrame, sets: DataFrame, how: Shingles) -> DataFrame:
    """The pairs (x, y) that link, by their whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column("p"), batch.column("q"), strict=True):
                p, q = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (p, q))
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                good.append(100 * both >= how.percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    own = sets.select("doc", "shingles")
    rows = pairs.join(own.select(F.col("doc").alias("x"), F.col("shingles").alias("p")), "x").join(own.select(F.col("doc").alias("y"), F.col("shingles").alias("q")), "y")
    return rows.select("x", "y", "p", "q").mapInArrow(compare, "a long, b long")


@dataclass
class Level:
    """Nodes of one level: OR of the bits, least and most size and component, and the most that the bits of a set hide."""

    bits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hidden: np.ndarray

    @staticmethod
    def leaves(bits: np.ndarray, n: np.ndarray, component: np.ndarray) -> Level:
        return Level(bits, n, n, component, component, n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))

    def above(self, fan: int) -> Level:
        at = np.arange(0, len(self.low), fan)
        return Level(
            np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at),
            np.minimum.reduceat(self.first, at), np.maximum.reduceat(self.last, at), np.maximum.reduceat(self.hidden, at),
        )


def may_link(p: Level, q: Level, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether any document under node i of p can link with one under node j of q that is not in its component."""
    one = (p.first[i] == p.last[i]) & (q.first[j] == q.last[j]) & (p.first[i] == q.first[j])
    fits = (100 * p.high[i] >= percent * q.low[j]) & (100 * q.high[j] >= percent * p.low[i])
    good = np.flatnonzero(~one & fits)
    out = np.zeros(len(i), dtype=bool)
    for at in range(0, len(good), 4096):
        some = good[at : at + 4096]
        a, b = i[some], j[some]
        common_bits = np.bitwise_count(p.bits[a] & q.bits[b]).sum(axis=1, dtype=np.int64)
        most = common_bits + np.minimum(p.hidden[a], q.hidden[b])
        out[some] = (100 + percent) * most >= percent * (p.low[a] + q.low[b])
    return out


def walk(p: Level, q: Level, how: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that two trees cannot rule out, from the roots down."""
    up = [(p, q)]
    while max(len(up[-1][0].low), len(up[-1][1].low)) > 1:
        up.append((up[-1][0].above(how.fan), up[-1][1].above(how.fan)))
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for depth in range(len(up) - 1, -1, -1):
        a, b = up[depth]
        good = may_link(a, b, i, j, how.percent)
        i, j = i[good], j[good]
        if depth:
            below_a, below_b = len(up[depth - 1][0].low), len(up[depth - 1][1].low)
            child = np.arange(how.fan)
            i, j = (np.repeat(i, how.fan) * how.fan + np.tile(child, len(i))), np.repeat(j, how.fan)
            i, j = np.repeat(i, how.fan), np.repeat(j, how.fan) * how.fan + np.tile(child, len(j))
            inside = (i < below_a) & (j < below_b)
            i, j = i[inside], j[inside]
    return i, j


def _words(bits: pa.Array) -> np.ndarray:
    n = len(bits)
    return np.frombuffer(b"".join(bits.to_pylist()), dtype=np.uint64).reshape(n, -1)


def _ordered(table: pa.Table) -> tuple[np.ndarray, Level]:
    doc, n, component = (table.column(c).to_numpy() for c in ("doc", "n", "component"))
    order = np.lexsort((doc, n, component))
    return doc[order], Level.leaves(_words(table.column("bits"))[order], n[order], component[order])


def in_several(posts: DataFrame) -> DataFrame:
    """The rows (key, doc, component) of keys whose documents lie in several components."""
    posts = stage(posts, "shingle-sides")
    ends = posts.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return posts.join(ends.filter("low < high").select("key"), "key", "left_semi")


def rare_keys(sets: DataFrame, how: Shingles) -> DataFrame:
    """key and doc: of each set the shingles that others have, among as many of its rarest as two sets that link must share one of."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "shingles"):
            counts = batch.column("n").to_numpy()
            keys = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column("doc").to_numpy(), counts)), pa.array(np.repeat(counts, counts))], ["key", "doc", "n"])

    posts = stage(sets.select("doc", "n", "shingles").mapInArrow(spread, "key long, doc long, n long"), "shingle-whole-posts")
    often = stage(posts.groupBy("key").agg(F.count("*").alias("often")).filter("often > 1"), "shingle-often")
    shared = posts.join(often, "key").groupBy("doc", "n").agg(F.array_sort(F.collect_list(F.struct("often", "key"))).alias("keys"))
    # shingles that no other set has are the rarest
    first = F.col("n") - F.ceil(F.col("n") * how.percent / 100) + 1 - (F.col("n") - F.size("keys"))
    chosen = shared.filter(first > 0).select("doc", F.explode(F.slice("keys", 1, first.cast("int"))).alias("k"))
    return one_tree_for_like_keys(stage(chosen.select("k.key", "doc"), "shingle-rare"))


def one_tree_for_like_keys(posts: DataFrame) -> DataFrame:
    """Shingles of a common passage have nearly the same documents: those alike in four of them, two picked by hash, share a tree of all theirs."""
    some = [F.min("doc"), F.max("doc"), F.min_by("doc", F.xxhash64("doc")), F.max_by("doc", F.xxhash64("doc"))]
    picked = [column.alias(name) for column, name in zip(some, "abcd", strict=True)]
    alike = stage(posts.groupBy("key").agg(*picked).filter("a < b"), "shingle-picked")
    trees = alike.join(alike.groupBy(*"abcd").agg(F.min("key").alias("tree")), [*"abcd"]).select("key", "tree")
    return posts.join(trees, "key").select(F.col("tree").alias("key"), "doc").distinct()


def tree_pairs(rows: DataFrame, how: Shingles) -> DataFrame:
    """Pairs of documents (x < y) of different components that the tree of a key cannot rule out.

    ``rows`` has key, doc, n, component and bits. Blocks of a tree are nodes of its top level.
    """
    kind = F.floor(F.col("n") / 16).alias("kind")
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / how.block).alias("blocks"))
    # a component of many sets of like size is cut further, so that no block is one of any size
    alike = rows.groupBy("key", "component", kind).agg(F.ceil(F.count("*") / how.block).alias("parts"))
    part = F.pmod(F.xxhash64("doc"), F.col("parts"))
    block = F.pmod(F.xxhash64("component", "kind", part), F.col("blocks")).alias("block")
    rows = rows.select("*", kind).join(alike, ["key", "component", "kind"]).join(sizes, "key").select(*rows.columns, block)
    rows = stage(rows, "tree-rows")
    node = "key long, block long, n_docs long, low long, high long, first long, last long, hidden long, bits binary"

    def top(table: pa.Table) -> pa.Table:
        _, level = _ordered(table)
        root = level.above(len(level.low))
        ints = {c: pa.array([int(getattr(root, c)[0])], pa.int64()) for c in ("low", "high", "first", "last", "hidden")}
        return pa.table({"key": table.column("key")[:1], "block": table.column("block")[:1], "n_docs": pa.array([table.num_rows], pa.int64()), **ints, "bits": pa.array([root.bits.tobytes()])})

    nodes = stage(rows.groupBy("key", "block").applyInArrow(top, node), "tree-nodes")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (
                Level(_words(batch.column(f"bits{s}")), *(batch.column(f"{c}{s}").to_numpy() for c in ("low", "high", "first", "last", "hidden")))
                for s in ("", "_2")
            )
            at = np.arange(batch.num_rows)
            yield batch.select(["key", "block", "block_2"]).filter(pa.array(may_link(p, q, at, at, how.percent)))

    # pairs of blocks, not of documents
    other = nodes.select("key", *[F.col(c).alias(f"{c}_2") for c in nodes.columns if c != "key"])
    both = nodes.join(other, "key").filter("block <= block_2").mapInArrow(prune, "key long, block long, block_2 long")
    both = stage(both, "tree-blocks")
    left = rows.join(both, ["key", "block"]).withColumn("side", F.lit(0))
    right = rows.withColumnRenamed("block", "block_2").join(both, ["key", "block_2"]).withColumn("side", F.lit(1))

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        (x, p), (y, q) = (_ordered(table.filter(pa.array(side == s))) for s in (0, 1))
        i, j = walk(p, q, how) if len(x) and len(y) else (np.zeros(0, np.int64),) * 2
        a, b = np.minimum(x[i], y[j]), np.maximum(x[i], y[j])
        return pa.table({"x": a[a < b], "y": b[a < b]})

    found = left.unionByName(right).groupBy("key", "block", "block_2").applyInArrow(meet, "x long, y long")
    return found.distinct()


def join(docs: DataFrame, how: Shingles = Shingles()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = stage(first_scan(docs, how), "shingle-documents")
    some = rows.filter("n > 0 and doc is not null")
    equal = stage(some.groupBy("n", "a", "b").agg(F.min("doc").alias("same")), "shingle-sets")
    own = some.join(equal, ["n", "a", "b"]).filter("doc = same")

    # documents by key; one exchange serves the count and the lookup
    posts = own.select(F.explode("keys").alias("key"), "doc").repartition("key")
    shared = posts.groupBy("key").agg(F.count("*").alias("often")).filter("often > 1")
    seen = stage(posts.join(shared, "key"), "shingle-shared")
    ranked = F.array_sort(F.collect_set(F.struct(-F.col("often"), "key")))
    kept = seen.groupBy("doc").agg(ranked.alias("keys")).join(some.groupBy("doc").agg(F.min("forget").alias("forget")), "doc")
    kept = kept.filter(F.size("keys") > F.col("forget")).select("doc", F.explode(F.expr("slice(keys, int(forget) + 1, size(keys))")).alias("k"))
    posts = stage(kept.select(F.col("k.key").alias("key"), "doc"), "shingle-posts")
    # near copies share many shingles: those with the same documents make one tree
    digest = [F.bit_xor(F.xxhash64("doc", F.lit(seed))).alias(name) for seed, name in enumerate("uv")]
    trees = posts.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("last"), F.count("*").alias("docs"), *digest)
    trees = trees.filter("pivot < last").groupBy("pivot", "last", "docs", "u", "v").agg(F.min("key").alias("key"), F.count("*").alias("times"))
    posts = stage(posts.join(stage(trees.select("key", "pivot", "times"), "shingle-keys"), "key"), "shingle-trees")

    wanted = equal.select(F.col("same").alias("doc"), "a", "b").join(posts.select("doc").distinct(), "doc", "left_semi")
    sets = stage(second_scan(docs, wanted, how), "shingle-whole")
    pairs = posts.filter("doc != pivot").groupBy("doc", "pivot").agg(F.sum("times").alias("times"))
    nearest = pairs.groupBy("doc").agg(F.max(F.struct("times", -F.col("pivot"), "pivot")).alias("best")).select(F.col("best.pivot").alias("x"), F.col("doc").alias("y"))
    nearest = stage(nearest, "shingle-nearest")
    edges = stage(compared(plausible(nearest, sets, how), sets, how), "shingle-links")
    # the other pivots of documents that are still apart from them
    names = stage(smallest_reachable(edges), "shingle-names")
    apart = posts.filter("doc != pivot").select("doc", "pivot").distinct()
    apart = named(named(apart, names, "doc", "component"), names, "pivot", "of_pivot").filter("component != of_pivot")
    again = apart.select(F.col("pivot").alias("x"), F.col("doc").alias("y")).join(nearest, ["x", "y"], "left_anti")
    edges = stage(edges.unionAll(compared(plausible(again, sets, how), sets, how)), "shingle-links")

    names = stage(smallest_reachable(edges), "shingle-names")
    apart = in_several(named(posts.select("key", "doc"), names, "doc", "component")).select("doc").distinct()
    rare = rare_keys(sets.join(stage(apart, "shingle-apart"), "doc", "left_semi"), how)
    trees = in_several(named(rare, names, "doc", "component")).join(sets.select("doc", "n", "bits"), "doc")
    left = compared(tree_pairs(trees, how), sets, how)
    names = smallest_reachable(edges.unionAll(left))

    found = rows.join(equal, ["n", "a", "b"], "left").join(names.withColumnRenamed("node", "same"), "same", "left")
    known = F.coalesce("component", "same", "doc")
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), known).alias("component_id"))


def named(rows: DataFrame, names: DataFrame, column: str, name: str) -> DataFrame:
    """The component of the documents of a column, by the links so far."""
    names = names.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(names, column, "left").withColumn(name, F.coalesce(name, column))


def representatives(docs: DataFrame, how: Shingles = Shingles()) -> DataFrame:
    """The documents with the smallest doc_id of their component, and those without doc_id, with all their columns.

    Of rows that repeat both doc_id and text, one is kept.
    """
    kept = join(docs, how).filter("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = rows.join(stage(kept, "shingle-kept"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return chosen.select("row.*").unionAll(rows.filter("doc_id is null").select("row.*"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, least(len(words), 1) + 1))) AS pos FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT a, b FROM both_ways UNION SELECT r.doc_id, w.b FROM reached r JOIN both_ways w ON w.a = r.other),
named AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, coalesce(m.other, t.doc_id)) AS component_id
FROM texts t LEFT JOIN sizes s USING (doc_id) LEFT JOIN named m USING (doc_id)
"""
