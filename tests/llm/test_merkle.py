"""The Merkle manifest against a plain tree over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelkit.llm import merkle

from .conftest import hard_texts

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fan):
    """The root, and for each node the runs above it with its places."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fan] for k in range(0, len(nodes), fan)]
        for i, k in enumerate(at):
            paths[i].append((runs[k // fan], k % fan))
        at = [k // fan for k in at]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def brute_force(rows, changed, fan=3):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    roots, kept = [], []
    for source in sources:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        root, paths = climb([leaf(r, r["text"]) for r in own], fan)
        roots.append(root)
        kept.append((own, paths))
    top, upper = climb(roots, fan)
    out = []
    for (own, paths), above, subroot in zip(kept, upper, roots, strict=True):
        for r, path in zip(own, paths, strict=True):
            digest, proof = leaf(r, changed(r)), ""
            for run, k in path + above:
                proof += "".join(run[:k] + run[k + 1 :])
                digest = sha("".join([*run[:k], digest, *run[k + 1 :]]))
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, top, sha(proof), digest, digest == top))
    return sorted(out, key=str)


def no_line_ends(row):
    even = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
    return row["text"].replace("\n", "") if even and row["text"] else row["text"]


def shown(rows):
    """The rows of a checked manifest, as the brute force has them."""
    hexes = [F.lower(F.hex(c)) for c in ("digest", "subroot", "root", "proof", "folded")]
    return sorted(map(tuple, rows.select("doc_id", *hexes, "verified").collect()), key=str)


def test_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = merkle.op11(spark, SMALL)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(docs, no_line_ends)
    assert found.filter("NOT verified").count() == sum(no_line_ends(r) != r["text"] for r in docs) > 20


@pytest.mark.parametrize("shape", [merkle.Shape(), merkle.Shape(depth=1), merkle.Shape(fan=2, depth=2), merkle.Shape(fan=5, depth=1)])
def test_of_hard_texts_in_rounds(documents, shape):
    docs = documents(*hard_texts(), *((20 + i, f"line {i}\n" * (i % 3), "b") for i in range(40)), *[(99, "the same", "a")] * 7)
    rows = merkle.proven(merkle.manifest(merkle.leaves(docs, F.lit(1).alias("other")), shape))
    assert shown(rows) == brute_force(docs.collect(), lambda r: r["text"], shape.fan)


def test_extended_without_the_old_texts(documents):
    old, new = documents(*((i, f"old {i}", "ab"[i % 2]) for i in range(30))), documents(*((30 + i, f"new {i}", "abc"[i % 3]) for i in range(11)))
    shape = merkle.Shape(depth=2)
    first = merkle.manifest(merkle.leaves(old), shape).select("key", "doc_id", "digest")
    rows = merkle.proven(merkle.manifest(first.unionAll(merkle.leaves(new)), shape))
    assert shown(rows) == brute_force(old.collect() + new.collect(), lambda r: r["text"])


def test_one_leaf_and_none(documents):
    assert merkle.manifest(merkle.leaves(documents())).count() == 0
    one = merkle.proven(merkle.manifest(merkle.leaves(documents((None, None, None))))).first()
    assert one["digest"] == one["root"] == one["folded"] and one["proof"] == hashlib.sha256().digest()


def test_one_key_is_dealt_to_many_tasks(documents):
    docs = documents(*[(None, "equal", "hot")] * 4000)
    found = merkle.leaves(docs).withColumn("row", F.monotonically_increasing_id())
    nodes = found.repartitionByRange(8, "key", "doc_id", "digest", "row")
    assert nodes.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000
    rows = merkle.manifest(merkle.leaves(docs), merkle.Shape(depth=3))
    assert rows.agg(F.countDistinct("place")).first()[0] == rows.agg(F.max("place")).first()[0] + 1 == 4000


def test_appender_closes_as_a_plain_tree():
    for n in range(1, 40):
        appender, nodes = merkle.Appender(3), [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        for node in nodes:
            appender.append(node)
        height = merkle.height_of(n, merkle.Shape())
        root = appender.close(height)
        assert root.hex() == climb([d.hex() for d in nodes], 3)[0]
        assert all(merkle.folded(d, *w) == root for d, w in zip(nodes, appender.witnesses(height), strict=True))
