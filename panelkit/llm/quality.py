"""A quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a text (``statistics``) are scaled to unit variance. Cosines of random projections of them approximate a
Gaussian kernel; together with the statistics themselves they are the inputs of a ridge regression on the label.
Each partition sums its normal equations, separately for each fold of doc_id, and Spark adds the sums. All folds together
give the model; all but one give the scores of that one, on which an isotonic step is fitted, over a grid of scores,
that turns them into shares of label 1. What reaches the driver is a few matrices and that grid, whatever the corpus.

Defined results: a null text is empty and gets the score of its statistics, all 0; rows that repeat a doc_id are scored
one by one; a label without document, or null, is ignored, and labels that repeat count as often; without any label every
score is 0.5; a null doc_id is not held out; an empty table gives no rows; other columns are kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

FOLDS = 5
#: Scores of the regression are cut to this range and counted on a grid of so many steps.
LOW, HIGH, GRID = -0.5, 1.5, 2000

#: Groups of bytes whose share of a text is a statistic.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "comma": b",",
    "shout": b"!", "mark": b"#$%&*@^~", "frame": b"|<>{}[]\\/_=+", "quote": b"\"'`;:()?-", "blank": b" \t", "line": b"\n\r",
    "beyond": bytes(range(128, 256)),
}
STATISTICS = (*CLASSES, "log_words", "log_bytes", "word_length", "word_spread", "long_words", "distinct", "top_word", "same_next", "marked_words", "line_words", "sentence_words", "repeated")


@dataclass(frozen=True)
class Fit:
    """Number of cosines, width of the kernel in standard deviations, weight of the ridge, and the least score accepted."""

    cosines: int = 128
    width: float = 6.0
    ridge: float = 1e-3
    accept: float = 0.3
    seed: int = 8


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text, from whole texts, by sums over the bytes and words of all texts at once."""
    words = common.Words(texts)
    raw, at, n = words.raw, words.text_at, len(texts)
    size = np.diff(at)
    group = np.full(256, len(CLASSES), dtype=np.uint8)
    for k, members in enumerate(CLASSES.values()):
        group[list(members)] = k
    text = np.repeat(np.arange(n), size)
    classes = group[raw]
    counts = np.bincount(text * (len(CLASSES) + 1) + classes, minlength=n * (len(CLASSES) + 1)).reshape(n, -1)[:, :-1]
    some = np.maximum(size, 1)
    out = {name: counts[:, k] / some for k, name in enumerate(CLASSES)}

    hashes, w = words.hashes(), words.counts
    many = np.maximum(w, 1)
    length = (words.stop - words.start).astype(np.float64)
    owner = np.repeat(np.arange(n), w)
    total = lambda x: np.bincount(owner, weights=x, minlength=n)
    mean = total(length) / many
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    run = np.diff(np.append(np.flatnonzero(fresh), len(order)))
    first = owner[order][fresh]
    top = np.zeros(n)
    np.maximum.at(top, first, run)
    next_same = np.zeros(len(hashes))
    next_same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    last_class = classes[words.stop - 1] if len(raw) else np.zeros(0, np.uint8)
    marked = np.isin(last_class, [list(CLASSES).index(c) for c in ("shout", "mark", "frame")])
    lines, stops = counts[:, list(CLASSES).index("line")] + 1, counts[:, list(CLASSES).index("stop")] + 1
    out |= {
        "log_words": np.log1p(w), "log_bytes": np.log1p(size), "word_length": mean, "word_spread": np.sqrt(np.maximum(total(length**2) / many - mean**2, 0)),
        "long_words": total(length > 14) / many, "distinct": np.bincount(first, minlength=n) / many, "top_word": top / many,
        "same_next": total(next_same) / many, "marked_words": total(marked) / many, "line_words": np.log1p(w / lines),
        "sentence_words": np.log1p(w / stops), "repeated": np.bincount(first, weights=run * (run > 3), minlength=n) / many,
    }
    return np.column_stack([out[name] for name in STATISTICS])


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % FOLDS


def described(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every document."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            rows = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(rows)], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(describe, "doc_id long, x array<double>")


def _lists(rows: np.ndarray) -> pa.Array:
    return common.list_array(pa.array(rows.ravel()), np.full(len(rows), rows.shape[1] if rows.ndim > 1 else 0))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    shares: np.ndarray

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([np.ones((len(z), 1)), z, cosines])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.inputs(x) @ self.weights, self.knots, self.shares)


def training_rows(found: DataFrame, labels: DataFrame) -> DataFrame:
    """fold, x and y of the labelled documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).filter("y is not null")
    known = known.withColumn("fold", remainder(F.col("doc_id"))).filter("fold != 0")
    return stage(found.join(known, "doc_id").select("fold", "x", "y"), "quality-training")


def fit(train: DataFrame, how: Fit = Fit()) -> Model | None:
    width = len(STATISTICS)
    moments = train.select(
        F.count("*"),
        *[F.avg(F.get("x", F.lit(k))) for k in range(width)],
        *[F.coalesce(F.stddev_pop(F.get("x", F.lit(k))), F.lit(0.0)) for k in range(width)],
    ).first()
    if not moments[0]:
        return None
    rng = np.random.default_rng(how.seed)
    model = Model(
        np.array(moments[1 : 1 + width]), np.maximum(np.array(moments[1 + width :]), 1e-6),
        rng.normal(size=(width, how.cosines)) / how.width, rng.uniform(0, 2 * np.pi, how.cosines),
        np.zeros(0), np.zeros(1), np.zeros(1),
    )
    m = 1 + width + how.cosines

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = model.inputs(_matrix(batch.column("x"), batch.num_rows))
            rows = np.hstack([x, batch.column("y").to_numpy()[:, None]])
            folds = batch.column("fold").to_numpy()
            for fold in np.unique(folds).tolist():
                own = rows[folds == fold]
                held[fold] = held.get(fold, 0) + own[:, :-1].T @ own
        for fold, matrix in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, fold)), pa.array(np.arange(m)), _lists(matrix)], ["fold", "row", "sums"]
            )

    def add(group: pa.Table) -> pa.Table:
        total = _matrix(group.column("sums").combine_chunks(), group.num_rows).sum(axis=0)
        return pa.table({"fold": group.column("fold")[:1], "row": group.column("row")[:1], "sums": _lists(total[None, :])})

    schema = "fold long, row long, sums array<double>"
    parts = train.mapInArrow(sums, schema).groupBy("fold", "row").applyInArrow(add, schema).collect()  # folds x inputs rows
    equations = np.zeros((FOLDS, m, m + 1))
    for fold, row, values in parts:
        equations[fold, row] = values
    whole = equations.sum(axis=0)

    def solve(e: np.ndarray) -> np.ndarray:
        penalty = how.ridge * max(e[0, 0], 1) * np.eye(m)
        penalty[0, 0] = 1e-9
        return np.linalg.solve(e[:, :-1] + penalty, e[:, -1])

    model.weights = solve(whole)
    others = np.stack([solve(whole - e) for e in equations])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((GRID + 1, 2))
        for batch in batches:
            x = model.inputs(_matrix(batch.column("x"), batch.num_rows))
            s = np.einsum("ij,ij->i", x, others[batch.column("fold").to_numpy()])
            step = np.rint((np.clip(s, LOW, HIGH) - LOW) / (HIGH - LOW) * GRID).astype(int)
            np.add.at(held, step, np.column_stack([np.ones(len(s)), batch.column("y").to_numpy()]))
        full = np.flatnonzero(held[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full, 0]), pa.array(held[full, 1])], ["step", "n", "y"])

    grid = train.mapInArrow(cross, "step long, n double, y double").groupBy("step").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    steps = np.array(sorted(tuple(r) for r in grid.collect()))  # GRID + 1 rows at most
    model.knots, model.shares = isotonic(LOW + steps[:, 0] / GRID * (HIGH - LOW), steps[:, 1], steps[:, 2] / steps[:, 1])
    return model


def isotonic(x: np.ndarray, weight: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to y, by pooling neighbours that fall; knots are the centres of its steps."""
    pools: list[list[float]] = []
    for at, w, v in zip(x, weight, y, strict=True):
        pools.append([at * w, w, v * w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    done = np.array(pools)
    return done[:, 0] / done[:, 1], np.clip(done[:, 2] / done[:, 1], 0, 1)


def _scores(model: Model | None, x: np.ndarray) -> np.ndarray:
    return np.full(len(x), 0.5) if model is None else model.score(x)


def score(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    found = stage(described(docs), "quality-statistics")
    model = fit(training_rows(found, labels), how)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(model, _matrix(batch.column("x"), batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    scored = found.mapInArrow(apply, "doc_id long, score double")
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= how.accept).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns; texts are read twice, never shuffled."""
    model = fit(training_rows(stage(described(docs), "quality-statistics"), labels), how)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            good = _scores(model, statistics(batch.column(at))) >= how.accept
            yield batch.filter(pc.equal(pa.array(good), True))

    return docs.mapInArrow(keep, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
