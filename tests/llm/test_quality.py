"""The quality classifier against plain statistics, direct least squares and a direct isotonic fit."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import quality

from .conftest import hard_texts

SF_DIR = "/root/testdata/sf0.01"


def plain_statistics(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    counts, n, size = collections.Counter(words), max(len(words), 1), max(len(raw), 1)
    out = {name: sum(b in members for b in raw) / size for name, members in quality.CLASSES.items()}
    length = [len(w) for w in words]
    mean = sum(length) / n
    out["log_words"], out["log_bytes"], out["word_length"] = math.log1p(len(words)), math.log1p(len(raw)), mean
    out["word_spread"] = math.sqrt(max(sum(x * x for x in length) / n - mean**2, 0))
    out["long_words"], out["distinct"] = sum(x > 14 for x in length) / n, len(counts) / n
    out["top_word"] = max(counts.values(), default=0) / n
    out["same_next"] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    marks = b"".join(quality.CLASSES[c] for c in ("shout", "mark", "frame"))
    out["marked_words"] = sum(w[-1] in marks for w in words) / n
    out["line_words"] = math.log1p(len(words) / (sum(b in b"\n\r" for b in raw) + 1))
    out["sentence_words"] = math.log1p(len(words) / (raw.count(b".") + 1))
    out["repeated"] = sum(k for k in counts.values() if k > 3) / n
    return [out[name] for name in quality.STATISTICS]


def test_statistics_of_hard_texts():
    texts = [t for _, t, _ in hard_texts()] + ["a a a a. b! c# [x]\nd, \"e\" F9"]
    assert np.allclose(quality.statistics(pa.array(texts)), [plain_statistics(t) for t in texts], rtol=1e-9, atol=1e-9)


def least_squares(x, y, penalty):
    """The ridge as rows of its own."""
    own = np.sqrt(np.append(1e-9, np.full(x.shape[1] - 1, penalty)))
    return np.linalg.lstsq(np.vstack([x, np.diag(own)]), np.append(y, np.zeros(len(own))), rcond=None)[0]


def rising(y, weight):
    """By the least of the means to the right of the largest to the left."""
    n = len(y)
    total, mass = np.append(0, np.cumsum(y * weight)), np.append(0, np.cumsum(weight))
    mean = np.array([[(total[j + 1] - total[i]) / (mass[j + 1] - mass[i]) if j >= i else np.nan for j in range(n)] for i in range(n)])
    return np.array([max(min(mean[i, k:]) for i in range(k + 1)) for k in range(n)])


def test_scores_are_those_of_direct_fits(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    how = quality.Fit(cosines=24)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    x = {i: plain_statistics(t) for i, t in texts.items()}
    fold = {i: zlib.crc32(str(i).encode()) % quality.FOLDS for i in texts}
    rows = [(r["doc_id"], r["quality"]) for r in labels.collect() if r["doc_id"] in texts and fold[r["doc_id"]]]
    train, y, folds = np.array([x[i] for i, _ in rows]), np.array([float(q) for _, q in rows]), np.array([fold[i] for i, _ in rows])
    mean, scale = train.mean(axis=0), np.maximum(train.std(axis=0), 1e-6)
    rng = np.random.default_rng(how.seed)
    projection, phase = rng.normal(size=(train.shape[1], how.cosines)) / how.width, rng.uniform(0, 2 * np.pi, how.cosines)

    def inputs(a):
        z = np.clip((a - mean) / scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, np.cos(z @ projection + phase) * np.sqrt(2 / how.cosines)])

    own = inputs(train)
    crossed = np.zeros(len(y))
    for k in set(folds.tolist()):
        rest = folds != k
        crossed[~rest] = own[~rest] @ least_squares(own[rest], y[rest], how.ridge * rest.sum())
    low, high, grid = quality.LOW, quality.HIGH, quality.GRID
    step = np.rint((np.clip(crossed, low, high) - low) / (high - low) * grid)
    steps = np.unique(step)
    weight = np.array([(step == s).sum() for s in steps])
    level = rising(np.array([y[step == s].mean() for s in steps]), weight)
    at = low + steps / grid * (high - low)
    pools = np.unique(level)
    knots = [np.average(at[level == v], weights=weight[level == v]) for v in pools]
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, labels, how).collect()}
    every = list(texts)
    expected = np.interp(inputs(np.array([x[i] for i in every])) @ least_squares(own, y, how.ridge * len(y)), knots, np.clip(pools, 0, 1))
    assert [found[i] for i in every] == pytest.approx(expected.tolist(), abs=1e-6)
