"""Brute-force versions share these helpers; the session is that of the other tests."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(n, links):
    """The smallest node each node can reach."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, row string, mix_size int, secret_row string, ids string"


@pytest.fixture
def documents(spark):
    """Documents with columns that operators use names of."""

    def make(*rows):
        full = [(i, t, None, s, None if t is None else len(t), "k", 1, "r", 2, "s", "i") for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


def hard_texts():
    """Null, empty, blank, short, long, repeated and odd texts as (doc_id, text, source)."""
    line = "the quick brown fox jumps over the lazy dog and runs away from every hound in town today "
    long = " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(9000))
    return [
        (0, None, None), (1, "", "a"), (2, " \t\n", "a"), (3, "one", "b"), (4, "one two three", "b"), (5, long, "c"),
        (6, long, "c"), (6, long, "c"), (7, long + " tail", None), (8, line * 8, "a"), (9, "intro " + line * 8, "b"),
        (10, "word " * 400, "c"), (11, "ünï cödé 中文字 emoji 😀😀   nbsp " * 12, "d"), (11, "another text of the same id", "d"),
        (None, line * 3, "e"), (None, "lost " * 70, "a"), (12, "A" * 5000, "b"), (13, "one two THREE", "b"), (14, "x\x00y\x1fz", "z"),
    ]
