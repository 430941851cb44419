"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own, and the product of both is a grid of cells. Two vectors of cosine 0.95
differ by a short step; a cell is worth a visit if that step may lead into it. From a vector to the points nearer to
another codeword than to its own lies at least the distance to the plane between the two; the squares of these distances
for both halves add up to the cost of a cell. Cells are visited in the order of their cost (in each half codewords are
sorted, and the sums are walked from the corner) up to the cost within which the target share of steps ends. That cost
is found beforehand on a bounded sample: steps of the full length in random directions from vectors of the sample.

Every vector lies in one cell and probes the cells it visits. Work is dealt out by codeword of the first half, and a
codeword with many vectors is cut into blocks of residents and of probes, so that a task holds two bounded blocks. Links are
counted there, in double precision; a pair that finds itself both ways counts once. No pairs are written: each block sends
counts per vector, and a spanning forest of its links for the components. Equal vectors are one vector with a number of copies.

Defined results: vectors that are null, empty, zero, of another length than most, or hold a null or non-finite component
link with nothing and are kept as their own component, as is a vector without id; rows that repeat a vec_id and its
vector count as copies, with another vector they are one node; a single vector and an empty table work; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common, vectors
from panelkit.llm.components import smallest_reachable
from panelkit.sources.staging import stage


@dataclass(frozen=True)
class Links:
    """Least cosine of a link; share of links to be found; vectors the codebooks are fitted on; vectors in a cell; a block."""

    cosine: float = 0.95
    recall: float = 0.999
    sample: int = 16_384
    cell: int = 32
    most_codewords: int = 512
    block: int = 4096
    seed: int = 2


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))
        for c in np.flatnonzero(counts):
            centres[c] = x[own == c].mean(axis=0)
    return np.unique(centres, axis=0)


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :], 0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(squares(x, centres), axis=1)


@dataclass
class Index:
    """Both codebooks and the cost up to which cells are visited."""

    books: tuple[np.ndarray, np.ndarray]
    reach: float = 0.0

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        cut = self.books[0].shape[1]
        return [x[:, :cut], x[:, cut:]]

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([nearest(h, b) for h, b in zip(self.halves(x), self.books, strict=True)])

    def costs(self, x: np.ndarray) -> list[np.ndarray]:
        """For both halves the squared distance to the points of every codeword, 0 for the own."""
        out = []
        for h, b in zip(self.halves(x), self.books, strict=True):
            d = squares(h, b)
            own = np.argmin(d, axis=1)
            between = np.sqrt(squares(b, b))[own]
            out.append(np.where(between > 0, (d - d.min(axis=1, keepdims=True)) / np.maximum(2 * between, 1e-30), 0) ** 2)
        return out

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which vector visits which cell, as numbers of vectors and of cells, each vector's cells in the order of cost.

        The walk over sums of sorted costs, for all vectors at once: for each codeword of the first half, in order, the
        codewords of the second that stay within reach.
        """
        first, second = self.costs(x)
        order = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        a, b = (np.take_along_axis(c, o, axis=1) for c, o in zip((first, second), order, strict=True))
        deep = int((a <= self.reach).sum(axis=1).max(initial=1))
        wide = int((b <= self.reach).sum(axis=1).max(initial=1))
        total = a[:, :deep, None] + b[:, None, :wide]
        who, i, j = np.nonzero(total <= self.reach)
        cell = order[0][who, i] * len(self.books[1]) + order[1][who, j]
        rank = np.lexsort((total[who, i, j], who))
        return who[rank], cell[rank]


def fit(sample: np.ndarray, n: int, how: Links) -> Index:
    """Codebooks for ``n`` vectors, and the reach that catches the target share of steps as long as a link allows."""
    k = int(np.clip(round((n / how.cell) ** 0.5), 1, min(how.most_codewords, max(len(sample) // 8, 1))))
    cut = (sample.shape[1] + 1) // 2
    halves = sample[:, :cut], sample[:, cut:] if sample.shape[1] > 1 else np.zeros((len(sample), 1))
    index = Index(tuple(k_means(h, k, how.seed + s) for s, h in enumerate(halves)))
    rng = np.random.default_rng(how.seed)
    start = sample[rng.integers(0, len(sample), min(4 * len(sample), 8192))]
    aside = rng.normal(size=start.shape)
    aside -= (aside * start).sum(axis=1, keepdims=True) * start
    size = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    ends = how.cosine * start + np.sqrt(1 - how.cosine**2) * np.where(size > 0, aside / np.maximum(size, 1e-30), 0)
    codes = index.codes(ends)
    first, second = index.costs(start)
    rows = np.arange(len(start))
    index.reach = float(np.quantile(first[rows, codes[:, 0]] + second[rows, codes[:, 1]], how.recall)) + 1e-12
    return index


ASSIGNED = "rep long, copies long, embedding array<float>, cell int, visits array<int>"
DEALT = "part int, rblock int, pblock int, probe boolean, rep long, copies long, embedding array<float>, cell int, visits array<int>"


def assigned(distinct: DataFrame, index: Index, size: int) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = vectors.unit(vectors.matrix(part.column("embedding"), size))
                codes = index.codes(x)
                who, cell = index.visits(x)
                lists = common.list_array(pa.array(cell.astype(np.int32)), np.bincount(who, minlength=len(x)))
                own = pa.array((codes[:, 0] * len(index.books[1]) + codes[:, 1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("rep", "copies", "embedding")), own, lists], [c.split()[0] for c in ASSIGNED.split(", ")])

    return distinct.mapInArrow(assign, ASSIGNED)


def dealt(rows: DataFrame, wide: int, rblocks: np.ndarray, pblocks: np.ndarray) -> DataFrame:
    """Residents to all blocks of probes of their part, probes to all blocks of residents of the parts they visit."""
    names = [c.split()[0] for c in DEALT.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rep = batch.column("rep").to_numpy()
            salt = common.mixed(rep.view(np.uint64)).astype(np.int64) & ((1 << 40) - 1)
            home = batch.column("cell").to_numpy() // wide
            visits = batch.column("visits")
            owner = np.repeat(np.arange(n), np.diff(visits.offsets.to_numpy()))
            pairs = np.unique(np.column_stack([owner, visits.flatten().to_numpy() // wide]), axis=0)
            for probe, who, part, own, other in (
                (False, np.arange(n), home, rblocks, pblocks),
                (True, pairs[:, 0], pairs[:, 1], pblocks, rblocks),
            ):
                times = other[part]
                row = np.repeat(np.arange(len(who)), times)
                block_own = (salt[who] % own[part])[row]
                block_other = common.ragged(np.zeros(len(who)), times)
                r, p = (block_other, block_own) if probe else (block_own, block_other)
                for a in range(0, len(row), 8192):
                    some = slice(a, a + 8192)
                    ints = [pa.array(x[some].astype(np.int32)) for x in (part[row], r, p)]
                    taken = batch.take(pa.array(who[row[some]]))
                    yield pa.RecordBatch.from_arrays([*ints, pa.array(np.full(taken.num_rows, probe)), *taken.columns], names)

    return rows.mapInArrow(deal, DEALT)


def hung_together(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the smallest node of its tree, after links (a, b)."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def exact(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of the vectors as they are."""
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    return dot(p, q) / (np.sqrt(dot(p, p)) * np.sqrt(dot(q, q)))


def linked(how: Links, wide: int, size: int):
    """For one block of residents and one of probes: links counted per vector, and a forest of them."""

    def link(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        probe = group.column("probe").to_numpy()
        rep, copies, cell = (group.column(c).to_numpy() for c in ("rep", "copies", "cell"))
        original = vectors.matrix(group.column("embedding").combine_chunks(), size)
        x = vectors.unit(original)
        visits = group.column("visits").combine_chunks()
        offsets, flat = visits.offsets.to_numpy(), visits.values.to_numpy()
        part = group.column("part")[0].as_py()
        residents, probes = np.flatnonzero(~probe), np.flatnonzero(probe)
        # a row for each visit of a probe to a cell of this part
        spans = common.ragged(offsets[probes], (offsets[1:] - offsets[:-1])[probes])
        visitor = np.repeat(probes, (offsets[1:] - offsets[:-1])[probes])
        here = flat[spans] // wide == part
        visitor, target = visitor[here], flat[spans][here]
        order = np.argsort(target, kind="stable")
        visitor, target = visitor[order], target[order]
        by_cell = residents[np.argsort(cell[residents], kind="stable")]
        owner = np.repeat(np.arange(len(rep)), offsets[1:] - offsets[:-1])
        known = np.sort(owner * np.int64(1 << 31) + flat[offsets[0] : offsets[-1]])
        counts, label = np.zeros(len(rep)), np.arange(len(rep))
        for c in np.unique(target):
            ps = visitor[slice(*np.searchsorted(target, [c, c + 1]))]
            rs = by_cell[slice(*np.searchsorted(cell[by_cell], [c, c + 1]))]
            for at in range(0, len(ps), 256):  # nothing of the size of all links is kept
                some = ps[at : at + 256]
                near = x[some] @ x[rs].T
                i, j = np.nonzero(near >= how.cosine - 1e-12)
                close = np.flatnonzero(np.abs(near[i, j] - how.cosine) < 1e-9)
                good = rep[some[i]] != rep[rs[j]]
                good[close] &= exact(original[some[i[close]]], original[rs[j[close]]]) >= how.cosine
                a, b = some[i[good]], rs[j[good]]
                if len(a):
                    # the resident counts the link as well, unless it will find it on its own visit
                    wanted = b * np.int64(1 << 31) + cell[a]
                    back = known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] == wanted
                    counts += np.bincount(a, weights=copies[b], minlength=len(rep)) + np.bincount(b[~back], weights=copies[a[~back]], minlength=len(rep))
                    label = hung_together(label, a, b)
        some, moved = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(rep)))
        nothing = pa.nulls(len(some), pa.int64())
        return pa.table(
            {
                "a": np.concatenate([rep[some], rep[moved]]),
                "b": pa.concat_arrays([nothing, pa.array(rep[label[moved]])]),
                "n": pa.concat_arrays([pa.array(counts[some].astype(np.int64)), pa.nulls(len(moved), pa.int64())]),
            }
        )

    return link


def near_duplicates(rows: DataFrame, how: Links = Links()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    size = vectors.dimension(rows)
    part = vectors.takes_part(F.col("embedding"), size) & F.col("vec_id").isNotNull()
    good = rows.filter(part).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    distinct = stage(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    n = distinct.count()
    alone = rows.filter(~part).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if n == 0:
        return alone.withColumn("kept", F.lit(True))
    index = fit(vectors.unit(vectors.bounded_sample(distinct, "embedding", "embedding", how.sample, size)), n, how)
    wide = len(index.books[1])
    cells = stage(assigned(distinct, index, size), "vector-cells")
    # one number for each codeword reaches the driver
    home = dict(cells.groupBy(F.floor(F.col("cell") / wide)).count().collect())
    seen = cells.select(F.explode(F.array_distinct(F.transform("visits", lambda c: F.floor(c / wide)))).alias("part"))
    probes = dict(seen.groupBy("part").count().collect())
    blocks = [np.array([max(1, -(-d.get(k, 0) // how.block)) for k in range(len(index.books[0]))]) for d in (home, probes)]
    found = dealt(cells, wide, *blocks).groupBy("part", "rblock", "pblock").applyInArrow(linked(how, wide, size), "a long, b long, n long")
    found = stage(found, "vector-links")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    names = smallest_reachable(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    known = distinct.join(counts, "rep", "left").join(names, "rep", "left")
    known = known.select(
        "embedding",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    done = good.join(stage(known, "vector-known"), "embedding").select("vec_id", "n_links", "component_id")
    return done.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE given AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM given
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reached(vec_id, other) AS (SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
named AS (SELECT vec_id, min(other) AS other FROM reached GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT g.vec_id, coalesce(c.n, 0) AS n_links, least(g.vec_id, coalesce(m.other, g.vec_id)) AS component_id,
  least(g.vec_id, coalesce(m.other, g.vec_id)) = g.vec_id AS kept
FROM given g LEFT JOIN counted c USING (vec_id) LEFT JOIN named m USING (vec_id)
"""
