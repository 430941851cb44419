"""Benchmark passages in documents against a plain search of every window."""

import hashlib
import re

import numpy as np
import pytest

from panelkit.llm import contamination
from panelkit.llm.contamination import Automaton, Limits, matches

from .conftest import hard_texts

SMALL = "/root/testdata/sf0.001"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items, limits=Limits()):
    windows = {}
    for item, text in items:
        own = words(text)
        size = limits.window(len(own))
        for k in range(len(own) - size + 1) if own else ():
            windows.setdefault(tuple(own[k : k + size]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        own = words(text)
        hit, names = set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                found = windows.get(tuple(own[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        out.append((doc_id, len(own), sorted(hit), sorted(names)))
    return sorted(out, key=str)


def found(frame):
    rows = frame.select("doc_id", "n_words", "spans", "items").collect()
    return sorted(((r[0], r[1], [k for s in r[2] for k in range(s["start"], s["stop"])], r[3]) for r in rows), key=str)


LINE = "the quick brown fox jumps over the lazy dog and runs away from every hound in town today "
ITEMS = [
    (1, LINE), (2, "Fox JUMPS over"), (2, "away from every hound in town today intro the quick brown fox"), (3, ""), (4, None), (None, "lost lost LOST"),
    (5, "word " * 30), (6, "ünï cödé 中文字 emoji 😀😀 nbsp"), (7, "!!"), (8, "one"), (9, "dog-and.runs"), (10, "a b a b a b a b a b a b a b c"),
    (11, " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(40, 6000))),
]
MORE = [(50, "b a b a b a b a b a b a b a b a", "z"), (51, "a b " * 20 + "c", "z"), (52, "fox\x00jumps—over fox jumps over", "z"), (51, LINE.upper(), "y")]


@pytest.mark.parametrize("limits", [Limits(), Limits(length=3), Limits(length=12, coverage=0.4), Limits(length=1)])
@pytest.mark.parametrize("small", [False, True])
def test_hits_of_hard_texts(spark, documents, monkeypatch, limits, small):
    if small:
        monkeypatch.setattr(contamination, "BLOCK_WORDS", 3000)
        monkeypatch.setattr(contamination, "SEGMENT_WORDS", 50)
    docs, items = [*hard_texts(), *MORE], spark.createDataFrame(ITEMS, "item_id long, text string")
    if small:
        assert contamination.automata(items, limits).count() > 1
    frame = documents(*docs)
    assert found(matches(frame.select("doc_id", "text"), items, limits)) == brute_force([d[:2] for d in docs], ITEMS, limits)


def test_hits_of_a_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [(i, n, len(h), len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), bool(h)) for i, n, h, x in brute_force(docs, items)]
    assert sorted(map(tuple, contamination.op12(spark, SMALL).collect()), key=str) == sorted(expected, key=str)
    assert sum(e[-1] for e in expected) > 0


def test_nothing_to_find_or_to_search(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(matches(documents((1, LINE, "a")).select("doc_id", "text"), none)) == [(1, 18, [], [])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert matches(documents().select("doc_id", "text"), items).count() == 0


def test_cleaned_texts(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents((1, "Before: " + LINE + "- after", "a"), (2, "clean", "a"), (3, None, None), (4, "(word " + "word " * 20 + "end)", "b"))
    done = contamination.cleaned(docs, items)
    assert done.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "Before:  - after", 2: "clean", 3: None, 4: "( end)"}


def test_longest_matches_of_random_items():
    rng = np.random.default_rng(4)
    for _ in range(60):
        items = [[bytes([97 + x]) for x in rng.integers(0, 3, rng.integers(1, 25))] for _ in range(5)]
        size = int(rng.integers(1, 7))
        automaton = Automaton().build([(str(k), min(size, len(words)), words) for k, words in enumerate(items)])
        assert len(automaton.size) <= 2 * sum(map(len, items)) + 1
        text = [bytes([97 + x]) for x in rng.integers(0, 3, 60)]
        got = {(end, w, item) for end, w, names in automaton.stream(text) for item in names}
        want = set()
        for k, words in enumerate(items):
            w = min(size, len(words))
            passages = {tuple(words[a : a + w]) for a in range(len(words) - w + 1)}
            want |= {(a + w, w, str(k)) for a in range(61 - w) if tuple(text[a : a + w]) in passages}
        assert got == want
