import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelkit.llm import common, token_frames

from .conftest import hard_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODING = token_frames.Encoding(PATH, end_id=2)


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, start = [], 0
    for doc_id, text, _ in ordered:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, docs):
    return token_frames.write_shards(docs, common.run_folder(spark, "test-shards"), ENCODING)


def test_digests_of_hard_texts(spark, documents):
    rows = [*hard_texts(), (20, "it's They'LL <|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> café É é, é. 3rd,4th≠ ﬁ", "a")]
    found = token_frames.read_digests(written(spark, documents(*rows))).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(rows)


def test_empty_table(spark, documents):
    assert token_frames.read_digests(written(spark, documents())).count() == 0


def test_documents_asked_for_are_read_alone(spark, documents, monkeypatch):
    manifest = written(spark, documents(*hard_texts()))
    tokenizer = Tokenizer.from_file(PATH)
    found = {r["doc_id"]: r["ids"] for r in token_frames.read_documents(manifest, [5, 9, 77]).collect()}
    texts = {i: t for i, t, _ in hard_texts()}
    assert found == {i: [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2] for i in (5, 9)}


def test_a_damaged_frame_is_told(spark, documents):
    manifest = written(spark, documents((1, "some words of a text " * 50, "a")))
    path = manifest.first()["path"].removeprefix("file:")
    raw = bytearray(open(path, "rb").read())
    raw[20] ^= 0xFF
    open(path, "wb").write(bytes(raw))
    with pytest.raises(Exception):  # noqa: B017  the library's own error, or ours
        token_frames.read_digests(manifest).collect()


def test_shards_are_plain_zstandard(spark, documents):
    import io

    import zstandard

    manifest = written(spark, documents((1, "a b c", "a"), (2, None, "a")))
    raw = b"".join(open(r["path"].removeprefix("file:"), "rb").read() for r in manifest.orderBy("part").collect())
    ids = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    tokenizer = Tokenizer.from_file(PATH)
    assert np.frombuffer(ids, "<u4").tolist() == [*tokenizer.encode("a b c", add_special_tokens=False).ids, 2, 2]


def test_long_documents_take_several_frames(spark, documents, monkeypatch):
    monkeypatch.setattr(token_frames, "FRAME_IDS", 16)
    monkeypatch.setattr(token_frames, "SHARD_DOCS", 3)
    found = token_frames.read_digests(written(spark, documents(*hard_texts()))).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(hard_texts())
