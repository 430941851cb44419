import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import layer_name
from panelkit.functions import text
from panelkit.plans import index_file, marts
from panelkit.sources import delimited, staging, tables
from panelkit.sources.snapshot import Snapshot

HEADER = "\t".join(index_file.INDEX_HEADER)
LINES = [
    "01 Andalucía\tGeneral\tAnnual average index\t2024\t93,5",
    " Nacional \tNew dwelling\tAnnual variation\t2025\t-1,25",
    "18 Ceuta\tNew dwelling \tAnnual average index\t2025\t",
    "18 Ceuta\tSecond-hand dwelling\tAnnual average index\t2025\tNA",
]


def write(path, lines, header=HEADER):
    path.write_text("﻿" + header + "\n" + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_index_file(spark, tmp_path):
    parsed = index_file.parse_index(index_file.read_index(spark, write(tmp_path / "a.csv", LINES)))
    assert {tuple(r) for r in parsed.collect()} == {
        ("01", "Andalucía", "General", "Annual average index", 2024, 93.5),
        ("00", "Nacional", "New dwelling", "Annual variation", 2025, -1.25),
        ("18", "Ceuta", "New dwelling", "Annual average index", 2025, None),
        ("18", "Ceuta", "Second-hand dwelling", "Annual average index", 2025, None),
    }
    found = {r["check"]: r["failing_rows"] for r in index_file.index_checks(parsed, 3).run().collect()}
    assert found == {"number of geographies": 0, "index types": 0, "metric types": 0, "grain": 0}
    bad = index_file.index_checks(parsed.unionByName(parsed).filter("index_type = 'General'"), 3).run()
    found = {r["check"]: r["failing_rows"] for r in bad.collect()}
    assert found == {"number of geographies": 1, "index types": 2, "metric types": 1, "grain": 1}


def test_bad_number(spark, tmp_path):
    path = write(tmp_path / "a.csv", [LINES[0].replace("93,5", "abc")])
    raw = index_file.read_index(spark, path)
    assert index_file.parse_index(raw, strict=False).first()["value"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        index_file.parse_index(raw).collect()


def test_wrong_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", LINES, HEADER.replace("Periodo", "Period"))
    with pytest.raises(Exception, match="(?i)header"):
        index_file.read_index(spark, path).collect()
    with pytest.raises(delimited.HeaderError):
        delimited.assert_header(delimited.read_delimited(spark, path), index_file.INDEX_HEADER)
    assert delimited.assert_header(delimited.read_delimited(spark, path), HEADER.replace("Periodo", "Period").split("\t"))


def test_unknown_label_becomes_null(rows):
    raw = rows(index_file.INDEX_SCHEMA.simpleString()[7:-1].replace(",", ", ").replace(":", " "), ("00", "n", "Odd", "Annual variation", 2000, 1.0))
    got = index_file.stage_index(raw).first()
    assert (got.index_type, got.metric_type, got.is_national) == (None, "annual_variation_pct", True)


SCHEMA = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("n", T.LongType(), True)])


@pytest.fixture
def namespace(spark, tmp_path):
    tables.create_namespace(spark, "test_raw", "it's a test", str(tmp_path / "db"))
    tables.create_namespace(spark, "test_raw")
    yield "test_raw"
    spark.sql("DROP DATABASE test_raw CASCADE")


def test_load_replaces_and_reconciles(spark, rows, namespace):
    df = rows("n int, k string, extra int", (1, "a", 0), (None, "b", 0))
    for expected in (2, 2):
        assert tables.load_table(df, f"{namespace}.t", SCHEMA) == expected
    loaded = tables.source(spark, namespace, "t")
    assert loaded.columns == ["k", "n"] and loaded.schema["n"].dataType == T.LongType()
    assert {tuple(r) for r in loaded.collect()} == {("a", 1), ("b", None)}
    with pytest.raises(tables.SchemaError, match="2 rows loaded, 3 sent"):
        tables.reconcile_row_count(spark, f"{namespace}.t", 3)


def test_load_refuses_bad_frames(rows, namespace):
    with pytest.raises(Exception, match="NULL in required column k"):
        tables.load_table(rows("k string, n int", (None, 1)), f"{namespace}.u", SCHEMA)
    with pytest.raises(tables.SchemaError, match="missing columns"):
        tables.load_table(rows("k string", ("a",)), f"{namespace}.u", SCHEMA)


def test_views_and_tables(spark, rows, namespace):
    df = rows("k string", ("a",))
    assert tables.materialise_view(df, "a_view").count() == 1
    assert tables.materialise_table(df, f"{namespace}.m").count() == 1
    assert layer_name("t", " marts ", "main") == "marts.t"
    assert layer_name("t", None, "main") == "main.t"


def test_parquet_and_seed(spark, rows, tmp_path):
    tables.write_parquet(rows("n bigint, extra int, k string", (1, 2, "x")), f"{tmp_path}/p")
    got = tables.read_parquet(spark, f"{tmp_path}/p", SCHEMA)
    assert got.columns == ["k", "n"]
    with pytest.raises(Exception, match="(?i)missing|cannot be resolved"):
        tables.read_parquet(spark, f"{tmp_path}/p", T.StructType([T.StructField("nope", T.StringType())]))
    names = ",".join(marts.MAPPING_SCHEMA.names)
    (tmp_path / "seed.csv").write_text(f'{names}\n04,M-04,"A, B",a,H,01,G-01,g,false,true\n', encoding="utf-8")
    seed = tables.load_seed(spark, f"{tmp_path}/seed.csv", marts.MAPPING_SCHEMA).first()
    assert (seed.member_code, seed.member_name, seed.group_code, seed.is_autonomous) == ("04", "A, B", "01", True)


def test_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["x\tNA", "\tok"], "a\tb")
    got = delimited.read_delimited(spark, path, ["a", "b"], missing=text.MISSING_TOKENS)
    assert {tuple(r) for r in got.collect()} == {("x", None), (None, "ok")}


def test_staging(spark, rows):
    df = rows("a int", (1,), (2,))
    counted = staging.stage_counted(df, "t")
    assert counted.rows == 2 and counted.frame.schema == df.schema
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", staging.shared_dir(spark)).rstrip("/")
    first, second = staging.together(lambda: staging.stage(df, "x"), lambda: df.filter(F.col("a") > 1))
    assert (first.count(), second.count()) == (2, 1)


def test_ragged_rows_stop_the_read(spark, tmp_path):
    for k, bad in enumerate(("a\tb\tsurplus", "alone")):
        path = tmp_path / f"{k}.csv"
        path.write_text(f"x\ty\n1\t2\n{bad}\n", encoding="utf-8")
        with pytest.raises(Exception, match="(?i)malformed"):
            delimited.read_delimited(spark, str(path), ["x", "y"]).collect()
        with pytest.raises(Exception, match="(?i)malformed"):
            delimited.read_delimited(spark, str(path), ["x", "y"]).select("x").collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x\ty\n"one\ntwo"\t2\n', encoding="utf-8")
    assert [tuple(r) for r in delimited.read_delimited(spark, str(path), ["x", "y"]).collect()] == [("one\ntwo", "2")]


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def quoted_text(seed, n_rows, eol):
    """Rows of three fields with quotes, separators and line breaks inside."""
    r = random.Random(seed)

    def field():
        plain = "".join(r.choice("ab 1é") for _ in range(r.randrange(0, 6)))
        inner = "".join(r.choice(["a", "b", "\n", '""', "\t", ",", "\r\n", " ", "é", "\n\n"]) for _ in range(r.randrange(0, 9)))
        return r.choice([plain, plain, f'x{plain}"{plain}', f'"{inner}"', f'"{inner}"'])

    return 'a\t"b\n2"\tc' + eol + "".join("\t".join(field() for _ in range(3)) + eol for _ in range(n_rows))


def by_csv(text):
    """What Python reads; it does not tell an empty field from a missing one."""
    return list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))


@pytest.mark.parametrize("size", [40, 133, 1 << 27])
def test_quoted_files_by_splits(spark, tmp_path, small_splits, size):
    expected = []
    for k, eol in enumerate(["\n", "\r\n", "\n"]):
        text = quoted_text(k, 60, eol)
        (tmp_path / f"{k}.tsv").write_bytes(("\ufeff" * (k % 2) + text).encode())
        expected += by_csv(text)[1:]
    small_splits(size)
    got = delimited.read_delimited(spark, str(tmp_path), ["a", "b\n2", "c"])
    assert got.columns == delimited.read_delimited(spark, str(tmp_path)).columns
    assert sorted([v or "" for v in r] for r in got.collect()) == sorted(expected)


def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    text = quoted_text(7, 400, "\n")
    (tmp_path / "a.tsv").write_bytes(text.encode())
    one = spark.read.options(sep="\t", header=True, **delimited.CSV).csv(str(tmp_path))
    assert one.rdd.getNumPartitions() == 1
    expected = sorted(map(tuple, one.collect()), key=str)
    small_splits(512)
    lines = delimited.text_lines(spark, str(tmp_path), "\t")
    assert lines.rdd.getNumPartitions() == -(-len(text.encode()) // 512) > 10
    assert lines.groupBy("block").count().agg(F.max("count")).first()[0] < 200
    assert sorted(map(tuple, delimited.read_delimited(spark, str(tmp_path)).collect()), key=str) == expected


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} ""quoted""\tand, more' for i in range(300))
    (tmp_path / "a.tsv").write_text(f'x\ty\n1\t"{long}"\n2\tshort\n', encoding="utf-8")
    small_splits(100)
    got = {r["x"]: r["y"] for r in delimited.read_delimited(spark, str(tmp_path), ["x", "y"]).collect()}
    assert got == {"1": long.replace('""', '"'), "2": "short"}


def test_faulty_quotes_and_headers(spark, tmp_path, small_splits):
    small_splits(16)
    (tmp_path / "a.tsv").write_text('x\ty\n1\t"never closed\n2\t3\n', encoding="utf-8")
    with pytest.raises(delimited.QuoteError, match="a.tsv"):
        delimited.read_delimited(spark, str(tmp_path), ["x", "y"])
    (tmp_path / "a.tsv").write_text("\n\nx\ty\n1\t2\n\n", encoding="utf-8")
    (tmp_path / "b.tsv").write_text("x\ty\n", encoding="utf-8")
    (tmp_path / "c.tsv").write_text("", encoding="utf-8")
    assert [tuple(r) for r in delimited.read_delimited(spark, str(tmp_path), ["x", "y"]).collect()] == [("1", "2")]
    (tmp_path / "b.tsv").write_text("x\tz\n3\t4\n", encoding="utf-8")
    with pytest.raises(Exception, match="unexpected header in .*b.tsv"):
        delimited.read_delimited(spark, str(tmp_path), ["x", "y"]).collect()


def test_swapped_values_are_noticed(spark, rows, namespace):
    sent = rows("k string, n bigint", ("a", 1), ("b", None), ("b", None), ("c", 3))
    tables.load_table(sent, f"{namespace}.d", SCHEMA)
    held = sent.agg(*tables.digest(sent.columns)).first().asDict()
    tables.reconcile_content(sent.orderBy(F.desc("k")), "d", held)
    for other in ([("a", 3), ("b", None), ("b", None), ("c", 1)], [("a", 1), ("a", 1), ("b", None), ("c", 3)], [(None, 1), ("b", None), ("b", None), ("c", 3)]):
        loaded = rows("k string, n bigint", *other)
        with pytest.raises(tables.SchemaError, match="not the same"):
            tables.reconcile_content(loaded, "d", held)
        assert [tuple(r) for r in tables.content_check(sent, loaded).collect()] == [(4, 4, True)]
    with pytest.raises(tables.SchemaError, match="2 rows loaded, 4 sent"):
        tables.reconcile_content(sent.limit(2), "d", held)
    assert tables.content_check(sent, sent).count() == 0
    assert tables.content_check(sent.limit(0), sent.limit(0)).count() == 0


def test_a_snapshot_is_seen_whole_or_not_at_all(spark, rows, namespace):
    def seen():
        return [spark.table(f"{namespace}.{t}").first()[0] for t in ("one", "two")]

    for value in (1, 2):
        snapshot = Snapshot(spark, namespace)
        for name in ("one", "two"):
            snapshot.store(rows("v int", (value,)), name)
            assert value == 1 or seen() == [1, 1]
        assert snapshot.table("two").first()[0] == value
        published = snapshot.publish()
        assert seen() == [value, value] == [published[t].first()[0] for t in ("one", "two")]
    broken = Snapshot(spark, namespace)
    broken.store(rows("v int", (3,)), "one")
    with pytest.raises(Exception, match="(?i)column|schema"):
        broken.store(rows("other string", ("x",)), "two")
    assert seen() == [2, 2]
    assert Snapshot(spark, namespace).go_back() and seen() == [1, 1]


def test_seeds_are_strict(spark, tmp_path):
    schema = T.StructType([T.StructField("code", T.StringType(), False), T.StructField("flag", T.BooleanType())])
    path = tmp_path / "a.csv"
    path.write_text("code,flag\n01,true\n02,\n", encoding="utf-8")
    assert [tuple(r) for r in tables.load_seed(spark, str(path), schema).collect()] == [("01", True), ("02", None)]
    for bad in ("01,maybe", ",true", "01,true,3"):
        path.write_text(f"code,flag\n{bad}\n", encoding="utf-8")
        with pytest.raises(Exception, match="(?i)invalid|required|malformed"):
            tables.load_seed(spark, str(path), schema).collect()
