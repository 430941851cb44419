"""SentencePiece encoding and decoding, with giant documents encoded in parallel chunks.

A sequence of tokens is what the model's merges give exactly if every two neighbours are what the merges give for their
joined text. (The first merge to cross a border between two tokens would also cross it with these two alone.) So the
encoding of a long text is a path of compatible neighbours, the best one of weight 0 among paths of weight 0 or minus
infinity, and may be found in chunks:

1. The state at a border between chunks is the token that covers the character before it: one of the vocabulary's
   pieces that match there, or that character alone.
2. Each chunk computes a transfer matrix: 0 where a state at its left border leads to a state at its right one, else minus
   infinity. Where no piece of the vocabulary holds two neighbouring characters, no token crosses; a chunk with such a
   place needs its ends only, and its matrix is an outer sum.
3. Matrices are combined by the max-plus product, which is associative: first within blocks of chunks, in parallel, then
   over blocks; blocks then hand the states at their ends down to their chunks.
4. Each chunk is backtraced on its own: it encodes the text between its two states.

The ids equal those of the library on the whole text. Shorter documents go through the library as they are.

Defined results: null and empty texts have no ids; U+2581 is the model's blank and decodes to one; a text that does not
come back equal is told by ``decode``; rows that repeat a doc_id are encoded one by one; an empty table gives no rows;
other columns are kept, except ``ids``, ``n_tokens`` and ``round_trip``, which are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common
from panelkit.sources.staging import stage


@dataclass(frozen=True)
class Pieces:
    """The model's file, the length from which a text is a giant, and the size of its chunks, in characters."""

    path: str
    giant: int = 1 << 15
    chunk: int = 1 << 13
    block: int = 64


class Model:
    """The library's model, once as it is and once without the blank it puts before a text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        proto.normalizer_spec.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        pieces = [p for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED)]
        self.vocabulary = {p.piece for p in pieces}
        self.longest = max(map(len, self.vocabulary))
        #: neighbours that some piece joins
        self.joint = {x[k : k + 2] for x in self.vocabulary for k in range(len(x) - 1)}
        self.size = [0 if p.type == p.BYTE else len(p.piece) for p in proto.pieces]
        self.byte = {k: int(p.piece[3:5], 16) for k, p in enumerate(proto.pieces) if p.type == p.BYTE}

    def tokens(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """ids, and of each token the end in the text and in the ids; the bytes of a character unknown are one token."""
        ids = self.part.encode(text)
        ends, stops, at, rest = [], [], 0, 0
        for k, i in enumerate(ids):
            if i in self.byte:
                lead = self.byte[i]
                if rest == 0:
                    rest = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                rest -= 1
                if rest:
                    continue
                at += 1
            else:
                at += self.size[i] or 1
            ends.append(at)
            stops.append(k + 1)
        return ids, ends, stops

    def covering(self, text: str, at: int) -> list[tuple[int, int]]:
        """Begin and end of all tokens that may cover the character before ``at``."""
        found = {(at - 1, at)}
        for begin in range(max(0, at - self.longest), at):
            for end in range(at, min(len(text), begin + self.longest) + 1):
                if text[begin:end] in self.vocabulary:
                    found.add((begin, end))
        return sorted(found)

    def cuts(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """First and last place from low up to high that no token can cross."""
        free = lambda p: text[p - 1 : p + 1] not in self.joint
        first = next((p for p in range(max(low, 1), high) if free(p)), None)
        return None if first is None else (first, next(p for p in range(high - 1, low - 1, -1) if free(p)))


def normal_form(text: str) -> str:
    """What the model reads: blanks as U+2581, one before the text."""
    return ("▁" + text).replace(" ", "▁") if text else ""


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def transfer(model: Model, text: str, low: int, high: int, last: bool) -> tuple[list, list, np.ndarray]:
    """States at the borders ``low`` and ``high`` of a chunk, and the matrix between them."""
    left = model.covering(text, low) if low else [(0, 0)]
    right = model.covering(text, high)
    if last:
        right = [s for s in right if s[1] == high]
    far = float("-inf")
    cut = model.cuts(text, low, high)
    if cut is not None:
        lead = [0.0 if low == 0 or (t := model.tokens(text[b : cut[0]])[1]) and b + t[0] == e else far for b, e in left]
        tail = [0.0 if _ends_with(model, text[cut[1] : e], e - b) else far for b, e in right]
        return left, right, np.add.outer(lead, tail)
    matrix = np.full((len(left), len(right)), far)
    for i, (b0, e0) in enumerate(left):
        for j, (b1, e1) in enumerate(right):
            ends = model.tokens(text[b0:e1])[1]
            starts_well = low == 0 or (ends and b0 + ends[0] == e0)
            if starts_well and _ends_with(model, text[b0:e1], e1 - b1, ends):
                matrix[i, j] = 0.0
    return left, right, matrix


def _ends_with(model: Model, text: str, size: int, ends: list[int] | None = None) -> bool:
    ends = model.tokens(text)[1] if ends is None else ends
    return bool(ends) and len(text) - size == (ends[-2] if len(ends) > 1 else 0)


CHUNK = "key long, k long, text string, low int, high int, last boolean"
TRANSFER = "key long, block long, k long, n_left int, n_right int, matrix array<double>, left_begin array<int>, left_end array<int>, right_begin array<int>, right_end array<int>"


def _chunks(pieces: Pieces, longest: int):
    """Rows of chunks of normal form with as much text around them as a state can need."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                text, rows = normal_form(raw.as_py()), []
                for k, low in enumerate(range(0, len(text), pieces.chunk)):
                    high = min(low + pieces.chunk, len(text))
                    begin, end = max(0, low - longest), min(len(text), high + longest)
                    rows.append((key, k, text[begin:end], low - begin, high - begin, high == len(text)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["key", "k", "text", "low", "high", "last"]).cast(
                    pa.schema([("key", pa.int64()), ("k", pa.int64()), ("text", pa.string()), ("low", pa.int32()), ("high", pa.int32()), ("last", pa.bool_())])
                )

    return cut


def _spans(row: dict, side: str) -> list[tuple[int, int]]:
    return list(zip(row[f"{side}_begin"], row[f"{side}_end"], strict=True))


def _matrix(row: dict) -> np.ndarray:
    return np.array(row["matrix"]).reshape(row["n_left"], row["n_right"])


def _rows(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r["k"])


def _states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The state at every border on the best way from ``entry`` to ``leave``."""
    n = len(matrices)
    ahead = [np.where(np.arange(matrices[0].shape[0]) == entry, 0.0, -np.inf)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    behind = [np.where(np.arange(matrices[-1].shape[1]) == leave, 0.0, -np.inf)]
    for m in reversed(matrices):
        behind.append((m + behind[-1][None, :]).max(axis=1))
    return [int(np.argmax(ahead[k] + behind[n - k])) for k in range(n + 1)]


def giants(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """key and ids of giant texts; ``docs`` has key, unique, and text."""
    longest = Model(pieces.path).longest
    chunks = stage(docs.mapInArrow(_chunks(pieces, longest), CHUNK), "piece-chunks").repartition("key", "k")

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = model or Model(pieces.path)
            out = []
            for row in batch.to_pylist():
                left, right, matrix = transfer(model, row["text"], row["low"], row["high"], row["last"])
                out.append((row["key"], row["k"] // pieces.block, row["k"], len(left), len(right), matrix.ravel().tolist(), *zip(*left, strict=True), *zip(*right, strict=True)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    fields = T._parse_datatype_string(TRANSFER).fields
    names = [f.name for f in fields]
    ints = pa.list_(pa.int32())
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), ints, ints, ints, ints]
    steps = stage(chunks.mapInArrow(transfers, TRANSFER), "piece-transfers")

    def combine(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        whole = reduce(product, map(_matrix, rows))
        first, last = rows[0], rows[-1]
        return pa.table([pa.array([x], t) for x, t in zip(
            (first["key"], first["block"], first["k"], *whole.shape, whole.ravel().tolist(), first["left_begin"], first["left_end"], last["right_begin"], last["right_end"]), types, strict=True
        )], names)

    blocks = steps.groupBy("key", "block").applyInArrow(combine, TRANSFER)
    ends = "key long, block long, entry int, leave int"

    def over_blocks(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        matrices = [_matrix(r) for r in rows]
        total = reduce(product, matrices)
        found = _states(matrices, 0, int(np.argmax(total[0])))
        return pa.table(
            {"key": table.column("key"), "block": [r["block"] for r in rows], "entry": pa.array(found[:-1], pa.int32()), "leave": pa.array(found[1:], pa.int32())}
        )

    # one small matrix for each half million characters of a text, whose size Spark bounds
    borders = blocks.groupBy("key").applyInArrow(over_blocks, ends)
    states = "key long, k long, begin int, first int, stop int"

    def over_chunks(key: tuple, steps: pa.Table, border: pa.Table) -> pa.Table:
        rows = _rows(steps)
        found = _states([_matrix(r) for r in rows], border.column("entry")[0].as_py(), border.column("leave")[0].as_py())
        left = [_spans(r, "left")[s] for r, s in zip(rows, found[:-1], strict=True)]
        right = [_spans(r, "right")[s] for r, s in zip(rows, found[1:], strict=True)]
        ints = lambda x: pa.array(x, pa.int32())
        return pa.table(
            {"key": [r["key"] for r in rows], "k": [r["k"] for r in rows], "begin": ints([s[0] for s in left]), "first": ints([s[1] for s in left]), "stop": ints([s[1] for s in right])}
        )

    chosen = steps.groupBy("key", "block").cogroup(borders.groupBy("key", "block")).applyInArrow(over_chunks, states)

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = model or Model(pieces.path)
            out = []
            for row in batch.to_pylist():
                ids, ends, stops = model.tokens(row["text"][row["begin"] : row["stop"]])
                out.append(ids if row["first"] == row["begin"] else ids[stops[0] :])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), pa.array(out, pa.list_(pa.int32()))], ["key", "k", "ids"])

    parts = chunks.join(chosen, ["key", "k"]).mapInArrow(backtrace, "key long, k long, ids array<int>")
    return parts.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """The documents with ids and n_tokens."""
    own = docs.drop("ids", "n_tokens")
    is_giant = F.length(common.text_of("text")) >= pieces.giant
    small = own.filter(~is_giant)
    schema = T.StructType([*small.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in common.slices(batches, "text"):
            model = model or Model(pieces.path)
            found = model.whole.encode(pc.fill_null(batch.column("text"), "").to_pylist(), num_threads=1)
            counts = np.array([len(x) for x in found], dtype=np.int64)
            flat = np.fromiter((i for x in found for i in x), np.int32, int(counts.sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, common.list_array(pa.array(flat), counts), pa.array(counts)], [*batch.schema.names, "ids", "n_tokens"]
            )

    row = F.struct(*[F.col(c) for c in own.columns]).alias("row")
    large = stage(own.filter(is_giant).select(F.monotonically_increasing_id().alias("key"), row), "piece-giants")
    ids = giants(large.select("key", F.col("row.text")), pieces)
    done = large.select("key", "row").join(ids, "key").select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"))
    return small.mapInArrow(whole, schema).unionByName(done)


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (as unsigned 32-bit little-endian integers), decoded_sha256 and same, from the ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in common.slices(batches, "text"):
            model = model or Model(pieces.path)
            ids = [x.values.to_numpy(zero_copy_only=False) for x in batch.column("ids")]
            texts = model.whole.decode([x.tolist() for x in ids], num_threads=1)
            before = pc.fill_null(batch.column("text"), "").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    pa.array([a == b for a, b in zip(texts, before, strict=True)]),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "same"],
            )

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "ids")
    return rows.mapInArrow(read, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, same boolean")


def checked(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """The encoded documents with round_trip: whether their ids decode to their text."""
    schema = T.StructType([*encoded.drop("round_trip").schema.fields, T.StructField("round_trip", T.BooleanType())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in common.slices(batches, "text"):
            model = model or Model(pieces.path)
            texts = model.whole.decode(batch.column("ids").to_pylist(), num_threads=1)
            same = [a == b for a, b in zip(texts, pc.fill_null(batch.column("text"), "").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same)], [*batch.schema.names, "round_trip"])

    return encoded.drop("round_trip").mapInArrow(check, schema)


def default() -> Pieces:
    import public_tokenizers

    return Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(common.table(spark, sf_dir, "documents"), default()), default())
