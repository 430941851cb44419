"""The pipeline against a brute-force version of its stages, and the guard around the package."""

import collections
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import sentencepiece

import corpus_pipeline
from panelkit.llm import quality

from .conftest import words
from .test_documents import base_spans, near_copies

SMALL = "/root/testdata/sf0.001"


def redacted(text):
    out, at = [], 0
    for start, _, end, _ in base_spans(text):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_stages_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    good = {r["doc_id"] for r in quality.score(docs, labels).filter("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in good]
    kept = {i for i, _, component in near_copies(rows, 5, 80)[0] if i == component}
    clean = {i: (redacted(t), s) for i, t, s in rows if i in kept}
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert len(kept) < len(rows) < docs.count()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in found:
        assert (r["text"], r["source"]) == clean[r["doc_id"]]
        assert r["ids"] == model.encode(r["text"]) and r["round_trip"] and r["n_tokens"] == len(r["ids"])
        assert r["n_chars"] == len(r["text"])
    taken, size, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in found:
        taken[r["source"]] += len(words(r["text"]))
    for text, source in clean.values():
        size[source] += len(words(text))
        largest[source] = max(largest[source], len(words(text)))
    assert max(collections.Counter(r["doc_id"] for r in found).values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= sum(largest.values()) / 2
    assert all(taken[s] <= 2 * size[s] for s in size)


def test_all_but_the_last_stage_return_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_the_rest_imports_without_the_package():
    """As if the package were deleted, the other queries are there."""
    repo = Path(__file__).resolve().parents[2]
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name in ('corpus_pipeline', 'panelkit.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n"
        "assert len(e.queries()) > 60 and set(e.oracle_sql()) == set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=repo, check=True)
