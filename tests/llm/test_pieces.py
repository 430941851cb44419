import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from panelkit.llm import pieces

from .conftest import hard_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a" * 700, "ab" * 300, "the cat sat on the mat " * 40, "中文字符没有空格" * 60, "😀🇩🇪👩‍👩‍👧" * 40, "\n\n\t  x    y" * 50, "  lead and trail  ",
    "internationalisation" * 30, "▁▁ literal ▁blank", "\x00\x01" * 90, "é" * 200, "Ünïcödé" * 60, "0123456789" * 50, "<s></s><0x0A>" * 30,
]


@pytest.mark.parametrize(("giant", "chunk", "block"), [(40, 33, 2), (60, 50, 3), (1 << 15, 1 << 13, 64)])
def test_ids_equal_those_of_the_library(documents, giant, chunk, block):
    how = pieces.Pieces(PATH, giant, chunk, block)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = np.random.default_rng(6)
    mixed = ["".join(rng.choice(list("aeintshr  \n.é中"), 400)) for _ in range(8)]
    rows = [*((i, None if t is None else t[:3000], s) for i, t, s in hard_texts()), *((50 + k, t, "s") for k, t in enumerate([*ODD, *mixed]))]
    made = pieces.encode(documents(*rows), how).collect()
    expected = sorted(((i, model.encode(t or "")) for i, t, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in made), key=str) == expected
    assert all(r["n_tokens"] == len(r["ids"]) for r in made)


def test_columns_and_digests(documents):
    how = pieces.Pieces(PATH, 300, 100, 2)
    docs = documents(*hard_texts())
    made = pieces.encode(docs, how)
    assert made.columns == [*docs.drop("ids").columns, "ids", "n_tokens"]
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    expected = []
    for i, t, _ in hard_texts():
        ids = model.encode(t or "")
        expected.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert sorted(map(tuple, pieces.decode(made, how).collect()), key=str) == sorted(expected, key=str)
    assert all(r["round_trip"] for r in pieces.checked(made, how).collect())


def test_nothing(documents):
    how = pieces.Pieces(PATH)
    assert pieces.checked(pieces.encode(documents(), how), how).count() == 0


def test_products_are_associative():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random(s) < 0.5, 0.0, -np.inf) for s in ((2, 3), (3, 4), (4, 2)))
    assert (pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))).all()
