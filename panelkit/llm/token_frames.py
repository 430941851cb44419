"""Token ids of documents as seekable zstandard shards.

A shard holds the documents of one range of doc_id in ascending order. Each document is one frame (a very long one
several), compressed on its own and with a checksum of its own, so that a reader decompresses only what it asks for.
Behind the documents lie an index of doc_id and the seek table of the public "zstd seekable format"; both are skippable
frames, so any zstandard decoder reads the whole shard as the plain ids, little-endian unsigned 32-bit integers.

    frame of document 1 | frame of document 2 | ... | index | seek table

Defined results: a null text is empty and gives the end id alone; rows that repeat a doc_id are all kept, ordered by
text; a null doc_id comes first; an empty table gives no shard; other columns are ignored. Shards are written under a
name of the attempt and renamed when complete, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

# Fixed values of the public seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Ids in one frame and documents in one shard at most; what goes beyond opens another frame or shard.
FRAME_IDS, SHARD_DOCS = 1 << 20, 1 << 20
#: Text whose different words are encoded together, and how many plain words go into one call of the library.
ENCODE_BYTES, TOGETHER = 16 << 20, 2048

MANIFEST = "path string, part int, shard int, n_docs long, n_tokens long, first_id long, last_id long"


@dataclass(frozen=True)
class Encoding:
    """Which tokenizer to use, and what is known of it.

    ``word_end`` is what the last token of a run of letters ends with, for a tokenizer that drops white space, keeps runs
    of letters apart from marks and ignores case; None for any other, which then encodes whole texts.
    """

    path: str
    end_id: int | None = None
    word_end: str | None = "</w>"


class Encoder:
    """Encodes texts by the tokenizers library, each different word of a slice once.

    Nothing joins characters across white space, nor a Latin letter with a mark behind it, so the ids of a text are those
    of its parts in order. Parts of letters alone are given to the library many at a time; the ends of words tell which
    ids are whose.
    """

    LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"

    def __init__(self, encoding: Encoding):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
        self.encoding, self.tokenizer = encoding, Tokenizer.from_file(encoding.path)
        self.closes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        if encoding.word_end:
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(encoding.word_end)]] = True

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of each."""
        found = [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        counts = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum())), counts

    def plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``each``, for words of letters alone."""
        ids, _ = self.each([" ".join(words[a : a + TOGETHER]) for a in range(0, len(words), TOGETHER)])
        counts = np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)
        return (ids, counts) if len(counts) == len(words) else self.each(words)

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``each``, by way of the different parts of all texts."""
        marked = pc.match_substring(texts, "<|")  # special tokens are looked for before anything else
        texts = pc.replace_substring(texts, "\n", " ")
        texts = pc.if_else(marked, texts, pc.ascii_lower(texts))
        lists = pc.split_pattern(pc.replace_substring_regex(texts, f"([{self.LETTERS}])([.,:;?!#$%&*])", r"\1 \2"), " ")
        codes = lists.flatten().dictionary_encode()
        is_plain = pc.match_substring_regex(codes.dictionary, f"^[{self.LETTERS}]+$")
        order = np.argsort(~is_plain.to_numpy(zero_copy_only=False), kind="stable")
        n_plain = pc.sum(is_plain).as_py() or 0
        sorted_words = codes.dictionary.take(pa.array(order)).to_pylist()
        (a, a_counts), (b, b_counts) = self.plain(sorted_words[:n_plain]), self.each(sorted_words[n_plain:])
        known, size = np.concatenate([a, b]), np.concatenate([a_counts, b_counts])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        which = place[codes.indices.to_numpy(zero_copy_only=False)]
        each = size[which]
        ids = known[common.ragged((np.cumsum(size) - size)[which], each)]
        before = np.concatenate([[0], np.cumsum(each)])
        return ids, np.diff(before[lists.offsets.to_numpy() - lists.offsets[0].as_py()])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``each``, null as empty, with the end id behind every text."""
        texts = pc.fill_null(texts, "")
        ids, counts = self.parts(texts) if self.encoding.word_end else self.each(texts.to_pylist())
        if self.encoding.end_id is None:
            return ids, counts
        total = counts + 1
        out = np.full(int(total.sum()), self.encoding.end_id, dtype=np.uint32)
        out[common.ragged(np.cumsum(total) - total, counts)] = ids
        return out, total


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard; ``close`` adds index and seek table and gives the shard its final name."""

    def __init__(self, folder: str, part: int, shard: int, attempt: int):
        import zstandard

        self.files, base = _files(folder)
        self.part, self.shard = part, shard
        self.name = f"{base}/ids-{part:06d}-{shard:04d}.zst"
        self.uri = f"{folder}/ids-{part:06d}-{shard:04d}.zst"
        self.partial = f"{base}/attempt-{attempt}-{part:06d}-{shard:04d}"
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(self.partial)
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.frames, self.docs = [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        self.docs.append((doc_id, len(self.frames), len(ids)))
        for a in range(0, max(len(ids), 1), FRAME_IDS):
            raw = ids[a : a + FRAME_IDS].astype("<u4").tobytes()
            packed = self.compressor.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> dict:
        ids = np.array([d[0] or 0 for d in self.docs], dtype="<i8")
        null = np.array([d[0] is None for d in self.docs], dtype="u1")
        first = np.array([d[1] for d in self.docs], dtype="<u4")
        sizes = np.array([d[2] for d in self.docs], dtype="<u8")
        index = struct.pack("<Q", len(ids)) + ids.tobytes() + null.tobytes() + first.tobytes() + sizes.tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        entries = np.array([*self.frames, (len(index) + 8, 0, 0)], dtype="<u4")
        seek = entries.tobytes() + struct.pack("<IBI", len(entries), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)
        self.out.close()
        self.files.move(self.partial, self.name)
        known = ids[null == 0]
        return {
            "path": self.uri, "part": self.part, "shard": self.shard, "n_docs": len(ids), "n_tokens": int(sizes.sum()),
            "first_id": int(known[0]) if len(known) else None, "last_id": int(known[-1]) if len(known) else None,
        }


class ShardReader:
    """Reads index and seek table, then the frames that are asked for, each against its checksum."""

    def __init__(self, uri: str):
        import zstandard

        files, path = _files(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri}: no seek table with checksums")
        self.frames = np.frombuffer(self.file.read_at(12 * n, size - 9 - 12 * n), dtype="<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        index = self.file.read_at(int(self.frames[-1, 0]) - 8, int(self.at[-2]) + 8)
        (docs,) = struct.unpack_from("<Q", index)
        self.doc_id = np.frombuffer(index, "<i8", docs, 8)
        self.null = np.frombuffer(index, "u1", docs, 8 + 8 * docs)
        self.first = np.append(np.frombuffer(index, "<u4", docs, 8 + 9 * docs), n - 1)
        self.sizes = np.frombuffer(index, "<u8", docs, 8 + 13 * docs).astype(np.int64)
        self.decompressor = zstandard.ZstdDecompressor()
        self.uri = uri

    def document(self, k: int) -> Iterator[bytes]:
        import xxhash

        for f in range(int(self.first[k]), int(self.first[k + 1])):
            packed, raw_size, checksum = self.frames[f].tolist()
            raw = self.decompressor.decompress(self.file.read_at(packed, int(self.at[f])), max_output_size=raw_size)
            if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
                raise ValueError(f"{self.uri}: frame {f} is damaged")
            yield raw


def write_shards(docs: DataFrame, folder: str, encoding: Encoding) -> DataFrame:
    """Encode every text and write the shards into ``folder``, a URI that executors reach; returns the manifest.

    One shuffle: documents are dealt out by ranges of doc_id, so each task writes one run of ids.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(common.width(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    types = {"path": pa.string(), "part": pa.int32(), "shard": pa.int32()}
    names = [c.split()[0] for c in MANIFEST.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        encoder, shards, writer = Encoder(encoding), [], None
        for batch in common.slices(batches, "text", ENCODE_BYTES):
            ids, counts = encoder.texts(batch.column("text"))
            stops = np.cumsum(counts)
            for doc_id, start, stop in zip(batch.column("doc_id").to_pylist(), stops - counts, stops, strict=True):
                if writer is None:
                    writer = ShardWriter(folder, task.partitionId(), len(shards), task.taskAttemptId())
                writer.add(doc_id, ids[start:stop])
                if len(writer.docs) == SHARD_DOCS:
                    shards.append(writer.close())
                    writer = None
        if writer is not None:
            shards.append(writer.close())
        if shards:
            yield pa.RecordBatch.from_arrays([pa.array([s[n] for s in shards], types.get(n, pa.int64())) for n in names], names)

    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the shards in order.

    The start of a shard is the sum of the shards before it; the window runs over one row per shard.
    """
    spark = manifest.sparkSession
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["path"])
                crcs = []
                for k in range(len(reader.sizes)):
                    crc = 0
                    for raw in reader.document(k):
                        crc = zlib.crc32(raw, crc)
                    crcs.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_id, mask=reader.null.astype(bool)),
                        pa.array(row["start"] + np.cumsum(reader.sizes) - reader.sizes),
                        pa.array(reader.sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.repartition(common.width(spark)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame, doc_ids: Iterable[int]) -> DataFrame:
    """The ids of the documents asked for; only their shards are opened and only their frames decompressed."""
    wanted = sorted(set(doc_ids))
    near = F.lit(False)
    for low, high in _runs(wanted):
        near = near | ((F.col("first_id") <= high) & (F.col("last_id") >= low))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                reader = ShardReader(path)
                for k in np.flatnonzero(np.isin(reader.doc_id, wanted) & (reader.null == 0)):
                    ids = np.frombuffer(b"".join(reader.document(k)), "<u4").astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([int(reader.doc_id[k])]), pa.array([ids])], ["doc_id", "ids"])

    return manifest.filter(near).select("path").mapInArrow(read, "doc_id long, ids array<long>")


def _runs(wanted: list[int], most: int = 64) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold all values."""
    step = -(-len(wanted) // most) or 1
    return [(x[0], x[-1]) for x in (wanted[a : a + step] for a in range(0, len(wanted), step))]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoding = Encoding(public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    docs = common.table(spark, sf_dir, "documents")
    return read_digests(write_shards(docs, common.run_folder(spark, "token-shards"), encoding))
