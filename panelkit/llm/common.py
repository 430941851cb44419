"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.sources.staging import shared_dir

#: Text handled at once inside a task; a single longer text makes a slice of its own.
SLICE_BYTES = 1 << 20
#: What separates words: the blank and the code points 9 to 13. Every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of a run below the shared folder of the cluster."""
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"


def width(spark: SparkSession) -> int:
    """The number of partitions the session shuffles to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each slice are about ``most`` bytes long."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, stop - start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins (one more entry than texts); null is empty."""
    kept = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(kept.buffers()[1], dtype=np.int64)[kept.offset : kept.offset + len(kept) + 1]
    data = kept.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of runs given by start and length, one run after the other."""
    lengths = lengths.astype(np.int64)
    if not len(lengths):
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, int(base)
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step % (1 << 64)
    return out[:n]


class Words:
    """The words of a slice of texts: where they are, which text they belong to, and a hash of each.

    A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D, which in UTF-8 is the same as the run of code
    points. Hashes are polynomials modulo 2**64 of scrambled bytes and of the length, scrambled once more; ``seed``
    picks one of two independent functions. ``solid`` names by value the bytes that belong to words, if others do.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, solid: np.ndarray | None = None):
        raw, self.text_at = text_bytes(texts)
        if lower:
            raw = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
        self.raw = raw
        solid = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))) if solid is None else solid[raw]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = self.text_at[1:-1]
        inner = inner[inner < len(raw)]
        first[inner] = solid[inner]  # a word ends with its text
        self.start = np.flatnonzero(first)
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        ends = inner[inner > 0] - 1
        last[ends] = solid[ends]
        self.stop = np.flatnonzero(last) + 1
        #: the first word of each text, and one entry more
        self.word_at = np.searchsorted(self.start, self.text_at)
        self.counts = np.diff(self.word_at)

    def hashes(self, seed: int = 0) -> np.ndarray:
        base = _MULTIPLIERS[seed]
        values = mixed(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIERS[1 - seed])
        out = np.empty(len(self.start), dtype=np.uint64)
        # by blocks of words, so that the sums stay in the cache
        block = 1 << 14
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        for a in range(0, len(self.start), block):
            start, stop = self.start[a : a + block], self.stop[a : a + block]
            low, high = int(start[0]), int(stop[-1])
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(values[self.raw[low:high]] * powers(base, high - low), out=sums[1:])
            back = powers(inverse, high - low + 1)
            out[a : a + block] = (sums[stop - low] - sums[start - low]) * back[start - low]
        return mixed(out + (self.stop - self.start).astype(np.uint64) * _MULTIPLIERS[1 - seed])


def windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp: the hash of every run of ``size`` words that lies in one text, and the number of runs of each text."""
    counts = np.maximum(words.counts - size + 1, 0)
    at = ragged(words.word_at[:-1], counts)
    n = len(hashes)
    if not len(at):
        return np.zeros(0, np.uint64), counts
    base = np.uint64(0xA0761D6478BD642F)
    out = np.empty(len(at), dtype=np.uint64)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    block = 1 << 16
    forward, back = powers(base, block + size + 1), powers(inverse, block + size + 1)
    for low in range(0, n, block):
        a, b = np.searchsorted(at, [low, low + block])
        if a == b:
            continue
        part = hashes[low : min(low + block + size, n)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * forward[: len(part)], out=sums[1:])
        p = at[a:b] - low
        out[a:b] = (sums[p + size] - sums[p]) * back[p]
    return mixed(out), counts


def by_text(values: np.ndarray, counts: np.ndarray, ufunc: np.ufunc) -> np.ndarray:
    """Reduce the runs of values given by their lengths; an empty run gives 0."""
    out = np.zeros(len(counts), dtype=values.dtype)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = ufunc.reduceat(values, starts)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def superseded(frame: DataFrame) -> None:
    """Delete the staged files of a frame that a newer one has replaced."""
    spark = frame.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
