"""A Merkle manifest of documents, with a witness for each of them.

Every document is a leaf. The leaves of a source, in the order of doc_id, are appended to a tree of ``fan`` children a
node; the roots of the sources, in the order of source, are appended to one more tree, whose root stands for the table.

Appending is incremental. A leaf opens subtrees, and what its witness lacks of one is known when the sibling that
completes the run arrives. The stream of a source is cut into aligned blocks of ``fan ** depth`` leaves, which tasks
append to on their own; the roots of the blocks are appended in the same way, block by block, until one is left.
The witness of a leaf is that within its block, then that of its block, and so on up to the root.

    leaves by (source, doc_id)   ->  place of each, by counts of the ranges they are dealt to
    blocks of a round            ->  witnesses within the block, roots = the next round's nodes
    roots of sources             ->  the same rounds once more
    witnesses of blocks          ->  passed down, one small row for each block

A digest is SHA-256; digests enter further digests as lower-case hex text. A witness is a list of steps from the leaf
to the root, one byte each (16 * nodes in the run + place in it), and the digests of the siblings, left to right.

Defined results: a null column is hashed as ``-`` and differs from an empty one; a null source is a source of its own,
the first; a null doc_id comes first in its source; rows that repeat a doc_id are ordered by their digests, equal rows
take neighbouring places; a document without siblings has an empty witness; an empty table gives no rows; columns other
than the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

HASHED = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "steps binary, siblings binary"
DIGEST = 32


@dataclass(frozen=True)
class Shape:
    """Children of a node (2 to 15), and levels that one task appends to on its own."""

    fan: int = 3
    depth: int = 8

    @property
    def block(self) -> int:
        return self.fan**self.depth


def combine(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


class Appender:
    """The subtrees of a stream of digests, kept by level; a node is added as soon as its run is complete."""

    def __init__(self, fan: int):
        self.fan, self.levels = fan, [[]]

    def append(self, digest: bytes, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        row = self.levels[level]
        row.append(digest)
        if len(row) % self.fan == 0:
            self.append(combine(row[-self.fan :]), level + 1)

    def close(self, height: int) -> bytes:
        """Complete the runs that are still open, up to the only node at ``height``."""
        for level in range(height):
            row = self.levels[level]
            if len(row) % self.fan:
                self.append(combine(row[len(row) - len(row) % self.fan :]), level + 1)
        return self.levels[height][0]

    def witnesses(self, height: int) -> list[tuple[bytes, bytes]]:
        """Steps and siblings of every leaf, from the top down, so that the parts that leaves share are made once."""
        known = [(b"", b"")]
        for level in range(height - 1, -1, -1):
            row, lower = self.levels[level], []
            for k, (steps, siblings) in enumerate(known):
                run = row[k * self.fan : (k + 1) * self.fan]
                for at in range(len(run)):
                    own = b"".join(run[:at] + run[at + 1 :])
                    lower.append((bytes([16 * len(run) + at]) + steps, own + siblings))
            known = lower
        return known


def height_of(n: int, shape: Shape) -> int:
    """Levels above ``n`` nodes in their block: up to the root, or ``depth`` where the stream has more blocks."""
    height, nodes = 0, n
    while nodes > 1 and height < shape.depth:
        nodes, height = -(-nodes // shape.fan), height + 1
    return height


def folded(leaf: bytes, steps: bytes, siblings: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    at = 0
    for step in steps:
        run, place = step >> 4, step & 15
        others = [siblings[at + DIGEST * k : at + DIGEST * (k + 1)] for k in range(run - 1)]
        at += DIGEST * (run - 1)
        leaf = combine([*others[:place], leaf, *others[place:]])
    return leaf


def field(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(text: str | Column = "text") -> Column:
    return F.unhex(F.sha2(F.concat(*(field(c) for c in HASHED[:-1]), field(text)), 256))


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add the place of each row among those of its ``key`` (from 0) and the number of them (total).

    Rows are dealt to ranges of (key, order), so one key spreads over many tasks; what a task has before its first row
    of a key is the sum of what earlier ranges count.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            places = []
            for key in batch.column("key").to_pylist():
                last, n = key, n + 1 if key == last else 1
                places.append(n - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "local"])

    sorted_nodes = nodes.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("part", F.spark_partition_id())
    placed = stage(sorted_nodes.mapInArrow(place, _ddl(sorted_nodes, "local long")), "merkle-places")
    counts = placed.groupBy("key", "part").agg(F.count("*").alias("own"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "key", "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"), F.sum("own").over(Window.partitionBy("key")).alias("total")
    )
    joined = placed.join(stage(counts, "merkle-counts"), ["key", "part"])
    return joined.withColumn("place", F.col("before") + F.col("local")).drop("part", "local", "before")


def _ddl(frame: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in frame.dtypes), *more])


def blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    """Add the witness of each node within its block, and the root of the block on the first node of it."""

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        appender = Appender(shape.fan)
        for digest in table.column("digest").to_pylist():
            appender.append(digest)
        total = table.column("total")[0].as_py()
        height = shape.depth if total > shape.block else height_of(total, shape)
        root = appender.close(height)
        steps, siblings = zip(*appender.witnesses(height), strict=True)
        for name, values in (("steps", steps), ("siblings", siblings), ("root", [root] + [None] * (len(steps) - 1))):
            table = table.append_column(name, pa.array(values, pa.binary()))
        return table

    cut = nodes.withColumn("block", F.floor(F.col("place") / shape.block).cast("long"))
    return cut.groupBy("key", "block").applyInArrow(grow, _ddl(cut, PATH, "root binary"))


def rounds(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """The nodes with their witnesses, then the roots of their blocks, until each key has one root."""
    done = []
    while True:
        done.append(stage(blocks(nodes, shape), "merkle-blocks"))
        nodes = done[-1].filter(F.col("root").isNotNull()).select(
            "key", F.col("block").alias("place"), F.ceil(F.col("total") / shape.block).cast("long").alias("total"), F.col("root").alias("digest")
        )
        most = nodes.agg(F.max("total")).first()[0]
        if most is None or most == 1:
            return [*done, nodes]


def passed_down(done: list[DataFrame], top: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Extend the witnesses of a round by those of its blocks, from the top (key, steps, siblings) to the first nodes."""
    upper = top.withColumn("place", F.lit(0).cast("long"))
    for k in range(len(done) - 2, -1, -1):
        above = upper.select("key", F.col("place").alias("block"), F.col("steps").alias("up"), F.col("siblings").alias("up_siblings"), *carried)
        joined = done[k].drop("root").join(above, ["key", "block"])
        upper = joined.withColumn("steps", F.concat("steps", "up")).withColumn("siblings", F.concat("siblings", "up_siblings")).drop("up", "up_siblings")
    return upper


def leaves(docs: DataFrame, *more: Column) -> DataFrame:
    """key (the source, null first), doc_id and digest of every document, and what else is to stay with a leaf."""
    key = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    return docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of().alias("digest"), *more)


def manifest(found: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """The leaves with place, subroot, root, and the witness up to the root (steps, siblings).

    ``found`` has key, doc_id and digest, from ``leaves``; other columns stay. Documents are needed for their leaves
    only: a manifest is extended by giving its leaves and those of new documents, without the old texts.
    """
    # equal rows are told apart, so that no number of them is one task's
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    own = rounds(numbered(found, ["doc_id", "digest", "row"]), shape)
    subroots = own[-1].select(F.lit("").alias("key"), F.col("key").alias("order"), "digest")
    upper = rounds(numbered(subroots, ["order"]), shape)
    root = upper[-1].select("key", F.lit(b"").alias("steps"), F.lit(b"").alias("siblings"), F.col("digest").alias("root"))
    top = passed_down(upper, root, ["root"]).select(F.col("order").alias("key"), "steps", "siblings", "root", F.col("digest").alias("subroot"))
    return passed_down(own, stage(top, "merkle-sources"), ["root", "subroot"]).drop("row", "block", "total")


def proven(rows: DataFrame, leaf: str = "digest") -> DataFrame:
    """Add proof (the digest of all siblings), folded (the root that ``leaf`` leads to) and verified."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [batch.column(c).to_pylist() for c in ("steps", "siblings", leaf, "root")]
            proofs, ends, right = [], [], []
            for steps, siblings, digest, root in zip(*paths, strict=True):
                proofs.append(combine([siblings]))
                ends.append(folded(digest, steps, siblings))
                right.append(ends[-1] == root)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(proofs, pa.binary()), pa.array(ends, pa.binary()), pa.array(right, pa.bool_())],
                [*batch.schema.names, "proof", "folded", "verified"],
            )

    return rows.mapInArrow(prove, _ddl(rows, "proof binary, folded binary, verified boolean"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 2 divides the crc32 of doc_id, the text is checked without its line ends."""
    docs = common.table(spark, sf_dir, "documents")
    changed = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    other = F.when(changed, leaf_of(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("other")
    rows = manifest(leaves(docs, other))
    rows = proven(rows.withColumn("other", F.coalesce("other", "digest")), "other")
    names = {"digest": "leaf", "subroot": "subroot", "root": "root", "proof": "proof_sha256", "folded": "folded_root"}
    return rows.select("doc_id", *(F.lower(F.hex(old)).alias(new) for old, new in names.items()), "verified")


ORACLE_SQL = r"""
WITH RECURSIVE
bits AS (
  SELECT b AS byte, b AS v, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS crc_table FROM bits WHERE k = 8),
texts AS (
  SELECT *, coalesce(xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda s, c: xor(s >> 8, crc_table[(xor(s, c) & 255) + 1])), 4294967295) % 2 = 0, false) AS even
  FROM documents, crc),
hashed AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
    text, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS other FROM texts),
leafs AS (
  SELECT doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(front || coalesce(strlen(other) || ':' || other, '-')) AS other FROM hashed),
own AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM leafs),
tree AS (
  SELECT source, 0 AS level, place, n, leaf AS digest FROM own
  UNION ALL
  SELECT source, level + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM tree WHERE n > 1 GROUP BY source, level, place // 3),
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM top WHERE n > 1 GROUP BY level, place // 3),
runs AS (SELECT source, level, place // 3 AS run, list(digest ORDER BY place) AS nodes FROM tree WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, place // 3 AS run, list(digest ORDER BY place) AS nodes FROM top WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT o.source, o.place, r.level, (o.place // (3 ** r.level)::BIGINT) % 3 AS pos, r.nodes
  FROM own o JOIN runs r ON o.source IS NOT DISTINCT FROM r.source AND r.run = o.place // (3 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT o.source, o.place, 1000 + r.level, (s.place // (3 ** r.level)::BIGINT) % 3, r.nodes
  FROM own o JOIN subroots s ON o.source IS NOT DISTINCT FROM s.source JOIN top_runs r ON r.run = s.place // (3 ** (r.level + 1))::BIGINT),
paths AS (
  SELECT source, place, list({'pos': pos, 'nodes': nodes} ORDER BY level) AS path,
    string_agg(array_to_string(list_concat(nodes[1:pos], nodes[pos + 2:]), ''), '' ORDER BY level) AS siblings
  FROM steps GROUP BY source, place),
whole AS (SELECT digest AS root FROM top WHERE n = 1),
folds AS (
  SELECT o.doc_id, o.leaf, s.digest AS subroot, w.root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_concat([{'pos': 0::BIGINT, 'nodes': [o.other]}], coalesce(p.path, [])),
      lambda a, b: {'pos': 0::BIGINT, 'nodes': [sha256(array_to_string(list_concat(b.nodes[1:b.pos], a.nodes, b.nodes[b.pos + 2:]), ''))]}).nodes[1] AS folded_root
  FROM own o JOIN subroots s ON o.source IS NOT DISTINCT FROM s.source CROSS JOIN whole w
  LEFT JOIN paths p ON o.source IS NOT DISTINCT FROM p.source AND o.place = p.place)
SELECT *, folded_root = root AS verified FROM folds
"""
