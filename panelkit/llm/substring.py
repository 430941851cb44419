"""Removal of passages that an earlier document has.

Every run of 50 words of every document gets a Rabin-Karp hash. A run that also starts in a document of smaller id is
removed with all its words; overlapping runs merge into one interval. Runs are judged on the input.

Most runs occur once and need not be shuffled to learn that. Each run has an anchor, the least hash among the runs of
25 words inside it; equal runs have equal anchors, and neighbouring runs mostly share theirs, so a document has about
one anchor for each 13 words. Only runs whose anchor occurs in two documents are counted, by both 64-bit hashes of each.
Documents with equal words throughout are reduced to the one of smallest id before that: all runs of the others go.

    scan 1: words, hash of the document, anchors   ->  copies, anchors that two documents share
    scan 2: runs with shared anchors               ->  smallest id of each run, runs to remove by document
    texts of scan 2 with their runs                ->  words kept

Defined results: a null text has no words; texts shorter than a run stay whole; rows that repeat a doc_id do not remove
each other's words, and each is treated by its own text; a null doc_id counts as larger than any other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

EMPTY = hashlib.sha256(b"").hexdigest()
LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Runs:
    """Words in a run, at least two."""

    size: int = 50

    @property
    def inner(self) -> int:
        return self.size // 2

    @property
    def inside(self) -> int:
        """Inner runs in a run."""
        return self.size - self.inner + 1


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


class Documents:
    """Words and runs of a slice of texts."""

    def __init__(self, texts: pa.Array, runs: Runs):
        self.runs, self.words = runs, common.Words(texts)
        self.hashes = [self.words.hashes(seed) for seed in (0, 1)]

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the words of each text, in order."""
        place = common.ragged(np.zeros(len(self.words.counts)), self.words.counts).astype(np.uint64)
        salted = [common.mixed(h + common.mixed(place + np.uint64(k + 1))) for k, h in enumerate(self.hashes)]
        return tuple(common.by_text(s, self.words.counts, np.add) for s in salted)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of every run, and the number of runs of each text."""
        inner, inner_counts = common.windows(self.words, self.hashes[0], self.runs.inner)
        counts = np.maximum(self.words.counts - self.runs.size + 1, 0)
        if not counts.any():
            return np.zeros(0, np.uint64), counts
        least = sliding_min(inner, self.runs.inside)
        return least[common.ragged(np.cumsum(inner_counts) - inner_counts, counts)], counts

    def full(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(common.windows(self.words, h, self.runs.size)[0] for h in self.hashes)

    def joined(self, k: int, keep: np.ndarray | None = None) -> bytes:
        """The words of text k, or those kept, with a blank between them."""
        a, b = self.words.word_at[k], self.words.word_at[k + 1]
        start, stop = self.words.start[a:b], self.words.stop[a:b]
        if keep is not None:
            start, stop = start[keep], stop[keep]
        if not len(start):
            return b""
        size = stop - start
        out = np.full(int(size.sum()) + len(size) - 1, 0x20, dtype=np.uint8)
        out[common.ragged(np.cumsum(size + 1) - size - 1, size)] = self.words.raw[common.ragged(start, size)]
        return out.tobytes()


def first_scan(docs: DataFrame, runs: Runs) -> DataFrame:
    """Per row: key (doc_id, null last), h (a hash of the text), n_words, hashes a and b of the words, digest of the whole, distinct anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            own = Documents(batch.column("text"), runs)
            a, b = own.digests()
            whole = [hashlib.sha256(own.joined(k)).hexdigest() for k in range(batch.num_rows)]
            anchor, counts = own.anchors()
            owner = np.repeat(np.arange(batch.num_rows), counts)
            fresh = np.ones(len(anchor), dtype=bool)  # neighbours mostly share theirs
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            anchor, owner = anchor[fresh], owner[fresh]
            order = np.lexsort((anchor, owner))
            anchor, owner = anchor[order], owner[order]
            fresh = np.ones(len(anchor), dtype=bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            lists = common.list_array(pa.array(common.signed(anchor[fresh])), np.bincount(owner[fresh], minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("h"), pa.array(own.words.counts.astype(np.int64)), pa.array(common.signed(a)), pa.array(common.signed(b)), pa.array(whole), lists],
                ["key", "h", "n_words", "a", "b", "whole", "anchors"],
            )

    return keyed(docs).mapInArrow(scan, "key long, h long, n_words long, a long, b long, whole string, anchors array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """Texts with what they are found again by: rows without doc_id, which all have one key, are told apart by a hash."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), F.xxhash64("text").alias("h"), "text")


def second_scan(texts: DataFrame, runs: Runs) -> DataFrame:
    """key, a, b and both hashes of each different run with a shared anchor; ``texts`` has the anchors of each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            own = Documents(batch.column("text"), runs)
            anchor, counts = own.anchors()
            x, y = own.full()
            stops = np.cumsum(counts)
            for k, (start, stop) in enumerate(zip(stops - counts, stops, strict=True)):
                shared = np.array(batch.column("shared")[k].values).view(np.uint64)
                at = start + np.flatnonzero(np.isin(anchor[start:stop], shared))
                at = at[np.unique(x[at], return_index=True)[1]]
                same = [pa.array(np.full(len(at), batch.column(c)[k].as_py())) for c in ("key", "a", "b")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(common.signed(x[at])), pa.array(common.signed(y[at]))], ["key", "a", "b", "x", "y"])

    return texts.mapInArrow(scan, "key long, a long, b long, x long, y long")


def remainders(texts: DataFrame, runs: Runs) -> DataFrame:
    """key, a, b, n_removed and the digest of the words kept; ``texts`` has the runs to remove as ``gone``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            own = Documents(batch.column("text"), runs)
            x, counts = common.windows(own.words, own.hashes[0], runs.size)
            stops, removed, kept = np.cumsum(counts), [], []
            for k, (start, stop) in enumerate(zip(stops - counts, stops, strict=True)):
                gone = np.isin(x[start:stop], np.array(batch.column("gone")[k].values).view(np.uint64)).astype(np.int64)
                steps = np.zeros(int(own.words.counts[k]) + 1, dtype=np.int64)
                steps[: len(gone)] += gone
                steps[runs.size : runs.size + len(gone)] -= gone
                keep = np.cumsum(steps)[:-1] == 0
                removed.append(int((~keep).sum()))
                kept.append(hashlib.sha256(own.joined(k, keep)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "a", "b")), pa.array(removed, pa.int64()), pa.array(kept)], ["key", "a", "b", "n_removed", "kept"]
            )

    return texts.mapInArrow(scan, "key long, a long, b long, n_removed long, kept string")


def dedup(docs: DataFrame, runs: Runs = Runs()) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    rows = stage(first_scan(docs, runs), "run-documents")
    first = stage(rows.filter(F.col("n_words") >= runs.size).groupBy("a", "b", "n_words").agg(F.min("key").alias("first")), "run-first")
    rows = rows.join(first, ["a", "b", "n_words"], "left")
    own = rows.filter(F.col("key") == F.col("first")).select("key", "h", "a", "b", F.explode("anchors").alias("anchor"))
    own = stage(own.distinct(), "run-anchors")
    shared = own.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("anchor")
    shared = stage(shared, "run-shared")
    wanted = own.join(shared, "anchor").groupBy("key", "h", "a", "b").agg(F.collect_list("anchor").alias("shared"))
    wanted = stage(wanted, "run-wanted")

    texts = stage(_own_texts(keyed(docs).join(wanted, ["key", "h"]), runs), "run-texts")
    found = stage(second_scan(texts, runs), "run-hashes")
    least = found.groupBy("x", "y").agg(F.min("key").alias("least"), F.max("key").alias("high")).filter("least < high")
    least = stage(least.select("x", "y", "least"), "run-least")
    gone = found.join(least, ["x", "y"]).filter("key > least").groupBy("key", "a", "b").agg(F.collect_set("x").alias("gone"))
    done = remainders(texts.drop("shared").join(gone, ["key", "a", "b"]), runs).distinct()

    copy = F.coalesce(F.col("key") > F.col("first"), F.lit(False))
    return rows.join(done, ["key", "a", "b"], "left").select(
        F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
    )


def _own_texts(joined: DataFrame, runs: Runs) -> DataFrame:
    """Keep the texts that their hashes belong to, where rows repeat a doc_id."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            a, b = Documents(batch.column("text"), runs).digests()
            right = (common.signed(a) == batch.column("a").to_numpy()) & (common.signed(b) == batch.column("b").to_numpy())
            yield batch.filter(pa.array(right))

    return joined.select("key", "a", "b", "text", "shared").mapInArrow(keep, "key long, a long, b long, text string, shared array<long>")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM texts),
runs AS (
  SELECT doc_id, words[pos] AS word, pos,
    CASE WHEN pos + 49 <= len(words) THEN md5(array_to_string(words[pos:pos + 49], ' ')) END AS run FROM placed),
earlier AS (SELECT run, min(doc_id) AS least FROM runs WHERE run IS NOT NULL GROUP BY run),
marked AS (SELECT r.*, coalesce(e.least < r.doc_id, false) AS gone FROM runs r LEFT JOIN earlier e USING (run)),
covered AS (
  SELECT *, max(gone) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS covered FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (covered) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT covered) AS rest
  FROM covered GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.rest, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""
