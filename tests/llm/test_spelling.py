"""Spelling variants against a comparison of all words with each other."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import spelling
from panelkit.llm.spelling import Spelling, Tree

from .conftest import hard_texts

SMALL = "/root/testdata/sf0.001"


def words_of(docs, how=Spelling()):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % how.misspelt == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= how.least_length and k >= how.least_n}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_force(words, factor=5):
    by_rest = collections.defaultdict(set)
    for w in words:  # only words that may be near are compared
        by_rest[w].add(w)
        for k in range(len(w)):
            by_rest[w[:k] + w[k + 1 :]].add(w)
    others = collections.defaultdict(set)
    for group in by_rest.values():
        for a in group:
            others[a] |= {b for b in group if near(a, b)}
    forms = {}
    for w, n in words.items():
        best = min(others[w], key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= factor * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(others[w]), words[forms[w]] if forms[w] else None))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def made_texts(seed=2, n_docs=60):
    """Texts with words of few letters, so that many are near, in chains of falling frequency."""
    rng = np.random.default_rng(seed)
    syllables = ["ab", "ba", "é", "ÿ", "À", "ac", "ca"]
    pool = ["".join(rng.choice(syllables, rng.integers(2, 9))) for _ in range(700)]
    pool += ["naturally", "naturaly", "natural", "naturraly", "naturalli", "x" * 300, "x" * 301, "x" * 299 + "y"]
    share = 1 / np.arange(1, len(pool) + 1) ** 1.3
    return [(i, " ".join(rng.choice(pool, 400, p=share / share.sum())) + " Naturally, naturaly " * (i % 3) + " " + "x" * (299 + i % 3)) for i in range(n_docs)]


@pytest.mark.parametrize("small", [False, True])
def test_variants_of_made_texts(documents, monkeypatch, small):
    if small:
        for name, value in (("CELL", 16), ("GUESTS", 2), ("SAMPLE", 100), ("LEAF", 2), ("PAIR_LETTERS", 500)):
            monkeypatch.setattr(spelling, name, value)
    docs = made_texts()
    how = Spelling(least_length=3, least_n=2, factor=2, misspelt=17)
    expected = brute_force(words_of(docs, how), 2)
    assert len({r[2] for r in expected}) < len(expected) and any(r[1] and r[1] != r[2] for r in expected)
    assert got(spelling.variants(documents(*((i, t, "s") for i, t in docs)), how)) == expected


def test_variants_of_hard_texts(documents):
    rows = [*hard_texts(), (20, "straße Straße ÉTÉété x×y÷z " * 9, "a"), (21, "letters" * 30 + " " + "q" * 70 + " ", "a"), *[(None, "unnamed unnamer " * 3, "b")] * 5]
    docs = [r[:2] for r in rows]
    for how in (Spelling(), Spelling(least_length=1, least_n=1, misspelt=3)):
        assert got(spelling.variants(documents(*rows), how)) == brute_force(words_of(docs, how))


def test_variants_of_a_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_force(words_of(docs))
    assert got(spelling.op13(spark, SMALL)) == expected
    assert sum(r[1] is not None for r in expected) > 10


def test_no_words(documents):
    assert spelling.variants(documents()).count() == 0
    assert spelling.variants(documents((1, None, "a"), (2, "a b c", "a"))).count() == 0


def test_words_of_one_point_are_dealt_in_parts(spark, monkeypatch):
    """Anagrams cannot be split by letter counts."""
    monkeypatch.setattr(spelling, "CELL", 8)
    rng = np.random.default_rng(1)
    names = sorted({"".join(rng.permutation(list("abcdefgh"))) for _ in range(300)} | {"abcdefgx", "abcdefghi", "bcdefgh"})
    words = dict.fromkeys(names, 7) | {"abcdefgx": 90}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r["word"]: (r["n_near"], r["near"]) for r in spelling.near_words(frame).collect()}
    expected = {w: [o for o in words if near(w, o)] for w in words}
    assert found == {w: (len(o), min(o, key=lambda x: (-words[x], x), default=None)) for w, o in expected.items()}


def test_reach_finds_every_box():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 4, (400, spelling.LETTERS)).astype(np.uint8)
    points[:, 6:] = 0
    tree = Tree.over(points, 3)
    home = dict(zip(*(x.tolist() for x in tree.reach(points, False, False)), strict=True))
    for up, down in ((True, True), (True, False), (False, True)):
        who, box = tree.reach(points, up, down)
        seen = set(zip(who.tolist(), box.tolist(), strict=True))
        assert len(seen) == len(who) < 400 * len(set(home.values())) / 2
        step = points[None].astype(int) - points[:, None].astype(int)
        ups, downs = np.maximum(step, 0).sum(2), np.maximum(-step, 0).sum(2)
        for a, b in zip(*np.nonzero((ups <= up) & (downs <= down)), strict=True):
            assert (a, home[int(b)]) in seen


def test_one_edit():
    rng = np.random.default_rng(6)
    for _ in range(2000):
        a = "".join(rng.choice(list("ab"), rng.integers(1, 6)))
        b = "".join(rng.choice(list("ab"), len(a) + rng.integers(0, 2)))
        codes = [spelling.codes_of(pa.array([w]), len(w)) for w in (a, b)]
        assert spelling.one_edit(*codes).tolist() == [near(a, b)]
