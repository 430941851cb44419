"""Removal of benchmark passages from documents, by a generalised suffix automaton of the benchmark.

A text is its words, lower-cased; a window of an item is ``length`` of its words in a row, or fewer where the limit of
coverage says so: the share ``coverage`` of the words of a short item, all of them by default. A document word is hit
where it lies in an occurrence of any window.

The automaton of all items holds every run of their words once. A document is streamed through it, which gives at each
word the longest run of any item that ends there; the states on the way of suffix links tell which windows are among its
endings, and of which items. Most words of a document cannot be part of an occurrence: they are not in the vocabulary of
the items, or not next to a word that follows there. Only stretches of words that follow each other in some item, and
are as long as the shortest window, are streamed.

    items         ->  segments that overlap by a window less one word  ->  automata of at most BLOCK_WORDS words and one segment
    each document ->  spans and items by the first automaton, joined by those of further automata on digests of the text

An automaton is bounded in words, whatever the size of the benchmark, and is broadcast; there are as many passes over the
documents as automata (one for 200,000 words).

Defined results: a null text has no words; an item without words has no window; a null item_id counts as an empty one;
rows that repeat an item_id are one item; rows that repeat a doc_id are each judged by their own text; empty tables give
no rows, or no hits; columns other than doc_id, item_id and the texts are ignored.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

#: Words of the segments that an item is cut to, and of the items that make one automaton.
SEGMENT_WORDS, BLOCK_WORDS = 1 << 12, 1 << 17
#: Bytes that belong to words: digits, letters, and all of any other character.
WORD_BYTES = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
SPANS = "array<struct<start:long,stop:long>>"
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


@dataclass(frozen=True)
class Limits:
    """Words in a row that no document may share with an item, and the share of a short item that is as bad."""

    length: int = 10
    coverage: float = 1.0

    def window(self, n: int) -> int:
        """Words in the windows of an item of ``n`` words."""
        return min(self.length, max(1, math.ceil(self.coverage * n - 1e-9)))


class Automaton:
    """Every run of the words of some items: a state holds the runs that end at the same places.

    ``after`` are the transitions of a state, ``link`` is the state of its longest ending that is not in it, ``size``
    the length of its longest run. ``marks`` are the windows in a state as (length, items); ``next_mark`` is the next
    state with marks on the way of links, 0 if none.
    """

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.after, self.link, self.size = [{}], [-1], [0]
        self.marks: dict[int, list[tuple[int, list[str]]]] = {}

    def _state(self, size: int, link: int, after: dict) -> int:
        self.size.append(size)
        self.link.append(link)
        self.after.append(after)
        return len(self.size) - 1

    def _branch(self, state: int, word: int, to: int) -> int:
        """The state of exactly the runs of ``state`` with ``word`` behind; ``to`` is split where it holds longer ones."""
        if self.size[to] == self.size[state] + 1:
            return to
        split = self._state(self.size[state] + 1, self.link[to], dict(self.after[to]))
        self.link[to] = split
        while state >= 0 and self.after[state].get(word) == to:
            self.after[state][word] = split
            state = self.link[state]
        return split

    def extend(self, last: int, word: int) -> int:
        """The state of the item so far with one more word; ``last`` is that without it."""
        if word in self.after[last]:
            return self._branch(last, word, self.after[last][word])
        new = self._state(self.size[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.after[state]:
            self.after[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._branch(state, word, self.after[state][word])
        return new

    def build(self, segments: list[tuple[str, int, list[bytes]]]) -> Automaton:
        """``segments`` are (item, length of its windows, words)."""
        numbers = [[self.ids.setdefault(w, len(self.ids)) for w in words] for _, _, words in segments]
        for words in numbers:
            last = 0
            for word in words:
                last = self.extend(last, word)
        windows: dict[tuple[int, int], set[str]] = {}
        for (item, window, _), words in zip(segments, numbers, strict=True):
            state = 0
            for k, word in enumerate(words):
                state = self.after[state][word]
                while self.size[self.link[state]] >= window:  # drops words before the window
                    state = self.link[state]
                if k + 1 >= window:
                    windows.setdefault((state, window), set()).add(item)
        for (state, window), items in sorted(windows.items(), key=lambda e: e[0]):
            self.marks.setdefault(state, []).append((window, sorted(items)))
        self.next_mark = [0] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            above = self.link[state]
            self.next_mark[state] = above if above in self.marks else self.next_mark[above]
        return self

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """End (exclusive), length and items of every window that occurs."""
        after, link, size, marks, next_mark = self.after, self.link, self.size, self.marks, self.next_mark
        state = longest = 0
        for k, word in enumerate(words):
            number = self.ids.get(word)
            while state and number not in after[state]:
                state = link[state]
                longest = size[state]
            if number not in after[state]:
                continue
            state, longest = after[state][number], longest + 1
            marked = state if state in marks else next_mark[state]
            while marked:
                for window, items in marks[marked]:
                    if window <= longest:
                        yield k + 1, window, items
                marked = next_mark[marked]


def segments_of(items: DataFrame, limits: Limits) -> DataFrame:
    """item, window and words of the parts of every item; each window of an item lies in one of its parts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            own = common.Words(batch.column("text"), lower=True, solid=WORD_BYTES)
            out: tuple[list, list, list] = ([], [], [])
            for k, item in enumerate(batch.column("item").to_pylist()):
                a, b = int(own.word_at[k]), int(own.word_at[k + 1])
                window = limits.window(b - a)
                for start in range(a, max(b - window + 1, a + 1) if b > a else a, SEGMENT_WORDS):
                    stop = min(start + SEGMENT_WORDS + window - 1, b)
                    out[0].append(item)
                    out[1].append(window)
                    out[2].append([own.raw[i:j].tobytes() for i, j in zip(own.start[start:stop], own.stop[start:stop], strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int32(), pa.list_(pa.binary())), strict=True)], ["item", "window", "words"])

    named = items.select(common.text_of(F.col("item_id").cast("string")).alias("item"), "text")
    return named.mapInArrow(cut, "item string, window int, words array<binary>")


def automata(items: DataFrame, limits: Limits) -> DataFrame:
    """Automata as pickled states, one a row; none has more than BLOCK_WORDS words and one segment."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made() -> pa.RecordBatch:
            a = Automaton().build(held)
            states = (a.ids, a.after, a.link, a.size, a.marks, a.next_mark, min(w for _, w, _ in held))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(states)], pa.binary())], ["states"])

        for batch in batches:
            for segment in zip(*(batch.column(c).to_pylist() for c in ("item", "window", "words")), strict=True):
                held.append(segment)
                n += len(segment[2])
                if n >= BLOCK_WORDS:
                    yield made()
                    held, n = [], 0
        if held:
            yield made()

    parts = stage(segments_of(items, limits), "leak-segments")
    words = parts.agg(F.sum(F.size("words"))).first()[0] or 0
    return stage(parts.repartition(max(1, math.ceil(words / BLOCK_WORDS))).mapInArrow(build, "states binary"), "leak-automata")


class Matcher:
    """Finds the occurrences of the windows of one automaton in the words of a slice of texts."""

    def __init__(self, states: tuple):
        self.automaton = Automaton()
        own = self.automaton
        own.ids, own.after, own.link, own.size, own.marks, own.next_mark, self.least = states
        by_number = [*own.ids]
        lengths = np.array([len(w) for w in by_number], dtype=np.int64)
        known = common.Words(pa.array([w.decode() for w in by_number], pa.string()), lower=True, solid=WORD_BYTES)
        assert len(known.start) == len(lengths)
        hashes = known.hashes()
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        #: by the low bits of a hash: whether a word of the items has them
        self.low = np.zeros(1 << 20, dtype=bool)
        self.low[self.hashes & np.uint64(len(self.low) - 1)] = True
        # words that follow each other in an item: the transitions between runs of one word and of two
        pairs = [own.ids[w] * len(by_number) + n for w in by_number for n in own.after[own.after[0][own.ids[w]]]]
        self.pairs = np.array(sorted(set(pairs)), dtype=np.int64)

    def numbers(self, words: common.Words) -> np.ndarray:
        """The number of each word by its hash, -1 for words of no item."""
        out = np.full(len(words.start), -1, dtype=np.int64)
        if not len(out):
            return out
        hashes = words.hashes()
        at = np.flatnonzero(self.low[hashes & np.uint64(len(self.low) - 1)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        right = self.hashes[place] == hashes[at]
        out[at[right]] = self.order[place[right]]
        return out

    def stretches(self, words: common.Words) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) words of stretches that may hold a window; hashes may let more pass."""
        numbers = self.numbers(words)
        first = np.zeros(len(numbers) + 1, dtype=bool)
        first[words.word_at] = True  # nothing follows the last word of a text
        known = numbers >= 0
        joined = known[:-1] & known[1:] & ~first[1:-1]
        at = np.flatnonzero(joined)
        pair = numbers[at] * len(self.order) + numbers[at + 1]
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[at] = self.pairs[place] == pair
        else:
            joined[at] = False
        begins = known.copy()
        begins[1:] &= ~joined
        ends = known.copy()
        ends[:-1] &= ~joined
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        long = stop - start >= self.least
        return start[long], stop[long]

    def found(self, words: common.Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """By text with hits: spans of words, counted in the text, and items."""
        out: dict[int, tuple[list, set]] = {}
        for start, stop in zip(*self.stretches(words), strict=True):
            own = [words.raw[i:j].tobytes() for i, j in zip(words.start[start:stop], words.stop[start:stop], strict=True)]
            text = int(np.searchsorted(words.word_at, start, side="right")) - 1
            base = int(start - words.word_at[text])
            for end, window, items in self.automaton.stream(own):
                spans, names = out.setdefault(text, ([], set()))
                names.update(items)
                spans.append((base + end - window, base + end))
        return {text: (merged(spans), names) for text, (spans, names) in out.items()}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _scan(docs: DataFrame, states: Broadcast | None) -> DataFrame:
    """The columns but ``text``, n_words, spans and items; ``states`` is an automaton, None for an empty benchmark."""
    names = [name for name in docs.columns if name != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(pickle.loads(states.value)) if states is not None else None
        for batch in common.slices(batches, "text"):
            words = common.Words(batch.column("text"), lower=True, solid=WORD_BYTES)
            found = matcher.found(words) if matcher else {}
            hits = [found.get(k, ([], set())) for k in range(batch.num_rows)]
            spans = pa.array([[{"start": a, "stop": b} for a, b in own] for own, _ in hits], SPAN_ARROW)
            items = pa.array([sorted(own) for _, own in hits], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(words.counts.astype(np.int64)), spans, items], [*names, "n_words", "spans", "items"]
            )

    kinds = "".join(f"`{name}` {kind}, " for name, kind in docs.select(*names).dtypes)
    return docs.mapInArrow(scan, f"{kinds}n_words long, spans {SPANS}, items array<string>")


def matches(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The columns of ``docs`` but text, with n_words, spans of hit words (start, stop; merged) and the items found.

    ``docs`` has text and no column named n_words, spans, items or digest.
    """
    spark, made = docs.sparkSession, automata(items, limits)
    n_made = made.count()
    if n_made < 2:
        block = made.first()
        return _scan(docs, spark.sparkContext.broadcast(block["states"]) if block else None)
    docs = docs.withColumn("digest", F.sha2(common.text_of("text"), 256))
    parts = []
    for block in made.toLocalIterator():
        states = spark.sparkContext.broadcast(block["states"])
        found = _scan(docs if not parts else docs.select("digest", "text"), states)
        parts.append(stage(found if not parts else found.filter(F.size("items") > 0).dropDuplicates(["digest"]).drop("n_words"), "leak-matches"))
        states.destroy()
    first, *more = parts
    by_text = functools.reduce(DataFrame.unionAll, more).groupBy("digest")
    more = by_text.agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    joined = first.join(more, "digest", "left").drop("digest")
    return joined.select(
        *(c for c in first.columns if c not in ("digest", "spans", "items")),
        _merged(F.when(F.col("more_spans").isNull(), F.col("spans")).otherwise(F.concat("spans", "more_spans"))).alias("spans"),
        F.when(F.col("more_items").isNull(), F.col("items")).otherwise(F.array_sort(F.array_union("items", "more_items"))).alias("items"),
    )


def _merged(spans: Column) -> Column:
    """Spans in order, those that touch or overlap as one: the natural form of ``merged``."""

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (span["start"] <= last["stop"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def cleaned(docs: DataFrame, items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Documents with their hit spans cut out of the text, from the first letter of the first word to the last of the last."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("row").field("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    words = common.Words(pa.array([text]), lower=True, solid=WORD_BYTES)
                    raw, at, kept = text.encode(), 0, []
                    for span in spans:
                        kept.append(raw[at : words.start[span["start"]]])
                        at = words.stop[span["stop"] - 1]
                    text = b"".join([*kept, raw[at:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "cleaned"])

    found = matches(docs.select(F.struct(*docs.columns).alias("row"), "text"), items, limits).select("row", "spans")
    done = found.mapInArrow(cut, f"row {dict(found.dtypes)['row']}, cleaned string")
    return done.select(*(F.col("cleaned").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matches(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
docs AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
sized AS (SELECT item_id, words, least(len(words), 10) AS size FROM items WHERE len(words) > 0),
starts AS (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM sized),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[pos:pos + size - 1], ' ') AS passage FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM docs, sizes),
found AS (
  SELECT p.doc_id, p.pos, p.size, w.item_id FROM placed p JOIN windows w
  ON w.size = p.size AND w.passage = array_to_string(p.words[p.pos:p.pos + p.size - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
