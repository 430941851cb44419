"""Groups of spelling variants: words one edit apart, each led to a much more frequent one, by k-d trees.

A word is a point: how often it has each letter. One edit moves it little: a replaced letter takes one off and puts one
on (a distance of two), an inserted letter puts one on (a distance of one). Words of one length make a k-d tree. A
search among words of its own length may leave the box of its point by one letter up and one down; among words one
longer, by one letter up; among words one shorter, by one down. Every box that it can reach is visited, all others are
pruned, and the order of the letters decides about the words found.

    documents           ->  words with their number
    sampled points      ->  top of the tree of each length: boxes of about CELL words
    every word          ->  home in its box, guest in all boxes in reach
    box by box          ->  tree of the words at home, searches of the guests, neighbours counted and the best kept
    best neighbours     ->  forms, then roots by joins of doubling reach

The top of a tree is fitted on at most about SAMPLE points and only steers the dealing: every word is dealt. A box with
more words at home than CELL, or 16 times as many guests, is dealt by hashes into parts, each part of the homes meeting
each of the guests, so that no task holds more, however many words share a point.

Defined results: a null text has no words; a null doc_id counts as an empty one; rows that repeat a doc_id count by their
own texts; a run of any length is a word; tables without words give no rows; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

#: Points that the tops of all trees are fitted on, words at home in a box, and letters of them.
SAMPLE, CELL, CELL_LETTERS = 1 << 16, 1 << 12, 1 << 20
#: Guests of a box in one task as a multiple of its words, words in a leaf of its tree, and letters that are compared at once.
GUESTS, LEAF, PAIR_LETTERS = 16, 8, 1 << 22
#: Letters: a-z, then U+00C0 to U+00FF, of which the UTF-8 bytes are C3 and 80 to BF.
LETTERS = 26 + 64
LATIN = 0xC3
#: Runs up to so many bytes go through the vectorised checksum, longer ones one by one.
SHORT = 64


@dataclass(frozen=True)
class Spelling:
    """Code points and occurrences that a word needs, how many times more frequent its form is, and which runs are misspelt."""

    least_length: int = 6
    least_n: int = 5
    factor: int = 5
    misspelt: int = 199


# --- words


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


class Runs:
    """The runs of letters of a slice of texts, in lower case: where they are, whose they are, and how long in code points."""

    def __init__(self, texts: pa.Array):
        raw, text_at = common.text_bytes(texts)
        upper = (raw >= 65) & (raw <= 90)
        self.raw = raw + upper * np.uint8(32)
        latin = raw == LATIN
        letter = ((self.raw >= 97) & (self.raw <= 122)) | latin
        letter[1:] |= latin[:-1]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[text_at] = True
        begins = letter.copy()
        begins[1:] &= ~letter[:-1] | edge[1:-1]
        ends = letter.copy()
        ends[:-1] &= ~letter[1:] | edge[1:-1]
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        before = np.concatenate([[0], np.cumsum(latin)])
        self.points = self.stop - self.start - (before[self.stop] - before[self.start])
        self.text = np.searchsorted(text_at, self.start, side="right") - 1

    def keep(self, which: np.ndarray) -> None:
        self.start, self.stop, self.points, self.text = (x[which] for x in (self.start, self.stop, self.points, self.text))

    def bytes_of(self, k: int) -> bytes:
        return self.raw[self.start[k] : self.stop[k]].tobytes()

    def checksums(self, prefixes: list[bytes]) -> np.ndarray:
        """crc32 of each run behind the prefix of its text."""
        first = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)
        length = self.stop - self.start
        order = np.argsort(-length, kind="stable")
        out = first[self.text]
        for k in order[: np.searchsorted(-length[order], -SHORT)]:
            out[k] = zlib.crc32(self.bytes_of(k), int(out[k]))
        order = order[np.searchsorted(-length[order], -SHORT) :]
        state, start, own = out[order] ^ np.uint32(0xFFFFFFFF), self.start[order], -length[order]
        for k in range(SHORT):
            n = int(np.searchsorted(own, -k))  # runs longer than k come first
            if not n:
                break
            state[:n] = CRC[(state[:n] ^ self.raw[start[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
        out[order] = state ^ np.uint32(0xFFFFFFFF)
        return out

    def strings(self) -> pa.Array:
        size = self.stop - self.start
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        data = self.raw[common.ragged(self.start, size)]
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data))


def word_counts(docs: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """word and n (occurrences) of every word."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            runs = Runs(batch.column("text"))
            runs.keep(runs.points >= how.least_length)
            sums = runs.checksums([f"{i}:".encode() for i in batch.column("id").to_pylist()])
            wrong = np.flatnonzero(sums % how.misspelt == 0)
            texts = []
            for k in wrong.tolist():
                word, at = runs.bytes_of(k).decode(), int(sums[k]) % int(runs.points[k])
                if len(word) > how.least_length:
                    texts.append(word[:at] + word[at + 1 :])
            runs.keep(sums % how.misspelt != 0)
            found = pc.value_counts(pa.chunked_array([runs.strings(), pa.array(texts, pa.large_string())]))
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    named = docs.select(common.text_of(F.col("doc_id").cast("string")).alias("id"), "text")
    counted = named.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= how.least_n)


# --- trees


def codes_of(words: pa.Array, length: int) -> np.ndarray:
    """The letters of words of one length, a row each."""
    raw, _ = common.text_bytes(words)
    latin = raw == LATIN
    value = np.where(raw >= 0x80, raw - np.uint8(0x80) + np.uint8(26), raw - np.uint8(97))
    return value[~latin].reshape(len(words), length)


def points_of(codes: np.ndarray) -> np.ndarray:
    """How often each word has each letter."""
    n, length = codes.shape
    flat = (np.arange(n, dtype=np.int64)[:, None] * LETTERS + codes).ravel()
    kind = np.uint8 if length < 255 else np.int64
    return np.bincount(flat, minlength=n * LETTERS).reshape(n, LETTERS).astype(kind)


class Tree:
    """A k-d tree over letter counts: node k has the points with fewer than cut[k] of letter[k] at left[k], the rest at right[k].

    A leaf has letter -1, and its number as left.
    """

    def __init__(self, letter: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.letter, self.cut, self.left, self.right = letter, cut, left, right

    @classmethod
    def over(cls, points: np.ndarray, leaf: int) -> Tree:
        """Split at the middle of the letter that varies most, until ``leaf`` points are left or all are equal."""
        nodes: list[list[int]] = [[-1, 0, 0, 0]]
        open_nodes, leaves = [(0, np.arange(len(points)))], 0
        while open_nodes:
            node, own = open_nodes.pop()
            part = points[own]
            letter = int(np.argmax(part.var(axis=0))) if len(own) > leaf else -1
            if letter < 0 or part[:, letter].min() == part[:, letter].max():
                nodes[node][2] = leaves
                leaves += 1
                continue
            values = np.sort(part[:, letter])
            middle = values[len(values) // 2]
            cut = int(middle) if middle > values[0] else int(values[np.searchsorted(values, middle, side="right")])
            right = part[:, letter] >= cut
            nodes[node] = [letter, cut, len(nodes), len(nodes) + 1]
            open_nodes += [(len(nodes), own[~right]), (len(nodes) + 1, own[right])]
            nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
        return cls(*np.array(nodes, dtype=np.int32).T)

    def reach(self, points: np.ndarray, up: bool, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """All (point, leaf) such that the box of the leaf is met by the point, one letter more if ``up`` and one less if ``down``.

        A search that goes to the side of a cut on which its point is not has used up its step; it goes on as the point
        with that letter changed.
        """
        who, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        more, less = np.full(len(points), -1, dtype=np.int64), np.full(len(points), -1, dtype=np.int64)
        found = []
        while len(who):
            letter = self.letter[node].astype(np.int64)
            done = letter < 0
            if done.any():
                found.append((who[done], self.left[node[done]]))
                who, node, more, less, letter = (x[~done] for x in (who, node, more, less, letter))
            cut = self.cut[node].astype(np.int64)
            value = points[who, letter].astype(np.int64) + (more == letter) - (less == letter)
            right = value >= cut
            steps = [(who, np.where(right, self.right[node], self.left[node]), more, less)]
            if up:
                can = (value == cut - 1) & (more < 0) & (less != letter)
                steps.append((who[can], self.right[node[can]], letter[can], less[can]))
            if down:
                can = (value == cut) & (less < 0) & (more != letter)
                steps.append((who[can], self.left[node[can]], more[can], letter[can]))
            who, node, more, less = (np.concatenate(x) for x in zip(*steps, strict=True))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one edit apart; ``b`` has as many columns as ``a``, or one more."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


def cell_words(length: int) -> int:
    """Words of a length that one task takes at home."""
    return max(1, min(CELL, CELL_LETTERS // length))


def tops(points: DataFrame, sizes: dict[int, int], share: int) -> dict[int, Tree]:
    """A tree of boxes for each length, fitted on one word in ``share``."""

    def fit(table: pa.Table) -> pa.Table:
        length = table.column("length")[0].as_py()
        own = points_of(codes_of(table.column("word").combine_chunks(), length))
        cells = math.ceil(sizes[length] / cell_words(length))
        tree = Tree.over(own, max(1, len(own) // cells))
        lists = [pa.array([x.tolist()], pa.list_(pa.int32())) for x in (tree.letter, tree.cut, tree.left, tree.right)]
        return pa.Table.from_arrays([pa.array([length], pa.int32()), *lists], ["length", "letter", "cut", "left", "right"])

    kind = "length int, letter array<int>, cut array<int>, left array<int>, right array<int>"
    sampled = points.filter(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).groupBy("length").applyInArrow(fit, kind)
    found = {r["length"]: Tree(*(np.array(r[c], dtype=np.int32) for c in ("letter", "cut", "left", "right"))) for r in sampled.collect()}
    whole = Tree(*np.array([[-1], [0], [0], [0]], dtype=np.int32))
    return {length: found.get(length, whole) for length in sizes}


def dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every word with each box (length, cell) that it may have neighbours in; home is that of its own point."""
    sent = words.sparkSession.sparkContext.broadcast({k: (t.letter, t.cut, t.left, t.right) for k, t in trees.items()})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: Tree(*arrays) for k, arrays in sent.value.items()}
        for batch in common.slices(batches, "word", 1 << 16):
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                points = points_of(codes_of(part.column("word"), length))
                for other in (length - 1, length, length + 1):
                    if other not in own:
                        continue
                    who, cell = own[other].reach(points, up=other >= length, down=other <= length)
                    home = np.full(len(part), -1, dtype=np.int64)
                    if other == length:
                        at, box = own[other].reach(points, up=False, down=False)
                        home[at] = box
                    columns = [part.column(c).take(pa.array(who)) for c in ("word", "n")]
                    size = pa.array(np.full(len(who), other, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [*columns, size, pa.array(cell.astype(np.int32)), pa.array(home[who] == cell)], ["word", "n", "length", "cell", "home"]
                    )

    return words.mapInArrow(deal, "word string, n long, length int, cell int, home boolean")


def _neighbours(table: pa.Table) -> pa.Table:
    """Of the words at home in a part of a box: how many of its guests are near, and the nearest of largest n."""
    length = table.column("length")[0].as_py()
    is_home = table.column("home")
    home = table.filter(is_home).combine_chunks()
    guests = table.filter(pc.invert(is_home)).sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
    names, own = guests.column("word"), codes_of(home.column("word").combine_chunks(), length)
    points = points_of(own)
    tree = Tree.over(points, LEAF)
    at, leaf = tree.reach(points, up=False, down=False)
    order = np.argsort(leaf, kind="stable")
    members, first = at[order], np.searchsorted(leaf[order], np.arange(len(tree.letter) + 1))
    counts, best = np.zeros(len(home), dtype=np.int64), np.full(len(home), len(guests), dtype=np.int64)
    sizes = pc.utf8_length(names).to_numpy()
    for other in (length - 1, length, length + 1):
        which, step, pairs = np.flatnonzero(sizes == other), cell_words(length + 1), max(1, PAIR_LETTERS // length)
        for a in range(0, len(which), step):
            part = which[a : a + step]
            theirs = codes_of(names.take(pa.array(part)).combine_chunks(), other)
            who, box = tree.reach(points_of(theirs), up=other <= length, down=other >= length)
            held = first[box + 1] - first[box]
            cuts = np.searchsorted(np.cumsum(held), np.arange(pairs, held.sum(), pairs)).tolist()
            for low, high in zip([0, *cuts], [*cuts, len(who)], strict=True):
                h = held[low:high]
                mine, guest = members[common.ragged(first[box[low:high]], h)], np.repeat(who[low:high], h)
                near = one_edit(theirs[guest], own[mine]) if other <= length else one_edit(own[mine], theirs[guest])
                counts += np.bincount(mine[near], minlength=len(home))
                np.minimum.at(best, mine[near], part[guest[near]])
    nearest = pa.array(best, mask=counts == 0)
    return pa.Table.from_arrays(
        [home.column("word"), home.column("n"), pa.array(counts), names.take(nearest), guests.column("n").take(nearest)],
        ["word", "n", "n_near", "near", "near_n"],
    )


def near_words(words: DataFrame) -> DataFrame:
    """word, n, n_near and, of the near words, the one of largest n (near, near_n); ``words`` has word and n."""
    words = stage(words.select("word", "n", F.char_length("word").alias("length")), "spelling-words")
    sizes = {r["length"]: r["rows"] for r in words.groupBy("length").agg(F.count("*").alias("rows")).collect()}
    share = max(1, math.ceil(sum(sizes.values()) / SAMPLE))
    rows = stage(dealt(words, tops(words, sizes, share)), "spelling-boxes")
    most = F.greatest(F.least(F.lit(CELL), F.floor(F.lit(CELL_LETTERS) / F.col("length"))), F.lit(1))
    parts = rows.groupBy("length", "cell").agg(F.sum(F.col("home").cast("int")).alias("homes"), F.count("*").alias("guests")).filter("homes > 0")
    parts = parts.select("length", "cell", F.ceil(F.col("homes") / most).alias("homes"), F.ceil(F.col("guests") / (most * GUESTS)).alias("guests"))
    rows = rows.join(stage(parts, "spelling-parts"), ["length", "cell"])

    def copies(frame: DataFrame, home: bool, seed: int, own: str, all_of: str) -> DataFrame:
        """Rows with their own part by a hash, for every part of the others."""
        part = F.pmod(F.xxhash64("word", F.lit(seed)), F.col(own)).alias(own)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(all_of) - 1)).alias(all_of)
        both = frame.select("word", "n", "length", "cell", F.lit(home).alias("home"), part, every)
        return both.select("word", "n", "length", "cell", "home", "homes", "guests")

    boxes = copies(rows.filter("home"), True, 1, "homes", "guests").unionAll(copies(rows, False, 2, "guests", "homes"))
    found = boxes.groupBy("length", "cell", "homes", "guests").applyInArrow(_neighbours, "word string, n long, n_near long, near string, near_n long")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), F.col("near"))))
    merged = found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for words with a form: the end of the chain of forms, reached by joins of doubling length.

    A chain has at most as many words as n allows, as n grows by the factor with each, so a few joins end it.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        if moved.filter("next IS NOT NULL").isEmpty():
            return now
        now = moved.select("word", "root")


def variants(docs: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts."""
    near = near_words(word_counts(docs, how))
    takes = F.col("near_n") >= how.factor * F.col("n")
    rows = near.select("word", "n", "n_near", F.when(takes, F.col("near")).alias("form"), F.when(takes, F.col("near_n")).alias("form_n"))
    rows = stage(rows, "spelling-forms")
    ends = roots(rows.filter("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE
bits AS (
  SELECT b AS byte, b AS v, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS crc_table FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
coded AS (
  SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)) AS codes FROM counted),
summed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], codes), lambda s, c: xor(s >> 8, crc_table[(xor(s, c) & 255) + 1])), 4294967295) AS h
  FROM coded, crc),
written AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words),
cut AS (SELECT word, n, pos, left(word, pos - 1) || '_' || substr(word, pos + 1) AS pattern, left(word, pos - 1) || substr(word, pos + 1) AS rest FROM spots),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (pattern) WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
