"""Folders of files with unlike headers, and cells with line breaks read by many tasks."""

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import types as T

from crewlens.sources import headers, readers, records
from tests.conftest import plan_of, values


def folder_of(tmp_path, name="t.csv", **files):
    folder = tmp_path / name
    folder.mkdir()
    for file, text in files.items():
        (folder / f"{file}.csv").write_text(text, encoding="utf-8")
    return str(folder)


# --- headers -------------------------------------------------------------------------------

def test_columns_are_matched_by_name_not_by_place(spark, tmp_path):
    path = folder_of(tmp_path, a="id,hours,days\n1,10,2\n2,20,3\n", b="id,days,hours\n3,4,30\n")
    df = readers.read_table(spark, path)
    assert df.columns == ["id", "hours", "days"]
    assert values(df, "id") == [("1", "10", "2"), ("2", "20", "3"), ("3", "30", "4")]


def test_missing_extra_blank_and_repeated_headers(spark, tmp_path):
    path = folder_of(
        tmp_path, a="id,hours\n1,10\n", b=" id ,note x,hours,hours\n2,n,20,21\n", c="﻿id\n3\n", d="", e="\n\n", f="id,hours\n",
    )
    df = readers.read_table(spark, path)
    assert df.columns == ["id", "hours", "note x", "hours.1"]
    assert values(df, "id") == [("1", "10", None, None), ("2", "20", "n", "21"), ("3", None, None, None)]
    found = headers.layouts(spark, path, clean=readers.clean_header)
    assert [len(x.files) for x in found] == [2, 1, 1]
    report = headers.layout_report(spark, found).select("layout", "n_files", "name", "position", "status")
    assert values(report, "layout", "name") == [
        (0, 2, "hours", 1, "known"), (0, 2, "id", 0, "known"),
        (1, 1, "hours", 2, "known"), (1, 1, "hours.1", 3, "repeated"), (1, 1, "id", 0, "known"), (1, 1, "note x", 1, "unknown"),
        (2, 1, "hours", None, "missing"), (2, 1, "id", 0, "known"),
    ]


def test_expected_columns(spark, tmp_path):
    path = folder_of(tmp_path, a="id,hours\n1,10\n", b="hours,id,more\n20,2,x\n")
    kept = readers.read_table(spark, path, expected=["hours", "id"])
    assert kept.columns == ["hours", "id", "more"]
    dropped = readers.read_table(spark, path, expected=["hours", "id"], unknown="drop")
    assert values(dropped, "id") == [("10", "1"), ("20", "2")]
    with pytest.raises(ValueError, match="'more' in .*b.csv"):
        readers.read_table(spark, path, expected=["hours", "id"], unknown="error")
    with pytest.raises(ValueError, match="wage"):
        readers.read_table(spark, path, expected=["id", "wage"])


def test_no_header_at_all(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        readers.read_table(spark, folder_of(tmp_path, a="", b="\n"))


def test_one_scan_per_layout_and_pruned_columns(spark, tmp_path):
    path = folder_of(tmp_path, **{f"f{i}": f"id,{'a,b' if i % 2 else 'b,a'},c\n{i},1,2,3\n" for i in range(12)})
    df = readers.read_table(spark, path)
    assert df.count() == 12 and {tuple(r) for r in df.select("a", "b").collect()} == {("1", "2"), ("2", "1")}
    plan = plan_of(df.select("id"))
    assert plan.count("FileScan csv") == 2 and "c:string" not in plan
    one = readers.read_table(spark, folder_of(tmp_path, "u.csv", a="x\n1\n", b="x\n2\n"))
    assert plan_of(one).count("FileScan csv") == 1


def test_ordinals_follow_file_order_over_layouts(spark, tmp_path):
    path = folder_of(tmp_path, a="v,w\n0,x\n1,x\n", b="w,v\nx,2\nx,3\n", c="v\n4\n", d="v,w\n5,x\n")
    df = readers.read_table(spark, path, ordinal=True)
    assert [r.v for r in df.orderBy("_row").collect()] == list("012345")
    mixed = folder_of(tmp_path, "m.csv", a="v,_row\n0,1\n", b="v\n1\n")
    with pytest.raises(ValueError, match="_row"):
        readers.read_table(spark, mixed, ordinal=True)


def test_header_longer_than_one_read_and_compressed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(headers, "FIRST_READ", 7)
    path = folder_of(tmp_path, a='id,"a long\nheader, with a ""quote""",z\n1,2,3\n')
    (tmp_path / "t.csv" / "b.csv.gz").write_bytes(gzip.compress(b"z,id\n9,8\n"))
    found = headers.layouts(spark, path)
    assert [x.names for x in found] == [("id", 'a long\nheader, with a "quote"', "z"), ("z", "id")]
    df = readers.read_table(spark, path, multi_line=True)
    assert sorted(values(df.select("id", "z"))) == [("1", "3"), ("8", "9")]


def test_names_of_files_with_blanks(spark, tmp_path):
    folder = tmp_path / "some sheet.csv"
    folder.mkdir()
    (folder / "part 1%.csv").write_text("a,b\n1,2\n")
    (folder / "part 2é.csv").write_text("b,a\n3,4\n")
    assert values(readers.read_table(spark, str(folder)), "a") == [("1", "2"), ("4", "3")]


def test_parquet_files_are_matched_by_name(spark, make, tmp_path):
    make("id long, a string", [(1, "x")]).write.parquet(str(tmp_path / "p"))
    make("b string, id long", [("y", 2)]).write.mode("append").parquet(str(tmp_path / "p"))
    df = readers.read_table(spark, str(tmp_path / "p"))
    assert values(df.select("id", "a", "b"), "id") == [(1, "x", None), (2, None, "y")]


# --- records -------------------------------------------------------------------------------

SHEET = (
    'id,"first\nheader",c\r\n1,"x\ny",2\r\n\r\n2,"a ""q"", b\r\nc\n\n\nd",\n3,,"é 日本"\n4,"""\n""",z\r\n'
    '5,"\n","\n\n"\n6,plain,"last\none"'
)


def expected_rows(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    return [tuple(c or None for c in r) for r in rows]


def test_splits_at_every_byte_give_the_same_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(SHEET.encode())
    want = expected_rows(SHEET)
    assert len(want) == 6
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    size = len(SHEET.encode())
    for split in (1, 2, 3, 5, 7, 16, 29, size // 2, size - 1, size):
        got = records.read_records(spark, str(path), schema, split_bytes=split)
        rows = got.orderBy("_file", "_start", "_seq").select("a", "b", "c").collect()
        assert [tuple(r) for r in rows] == want, split
    shuffled = records.read_records(spark, str(path), schema, split_bytes=9, most_blocks=0)
    assert sorted(tuple(r) for r in shuffled.select("a").collect()) == sorted((w[0],) for w in want)


def test_records_of_many_batches_and_blocks(spark, tmp_path):
    """Arrow batches of a few lines, so that records and blocks reach over them."""
    rows = [(str(i), "x" if i % 3 else f'l{i}\n"q"\n\nend', str(i % 5)) for i in range(500)]
    with (tmp_path / "t.csv").open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n").writerows([("a", "b", "c"), *rows])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for split in (50, 333, 1 << 20):
            got = records.read_records(spark, str(tmp_path / "t.csv"), schema, split_bytes=split)
            assert [tuple(r) for r in got.orderBy("_start", "_seq").select("a", "b", "c").collect()] == rows
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_blocks_share_tasks(spark, tmp_path):
    rows = [(str(i), f'l{i}\n"q"' if i % 2 else "x") for i in range(2000)]
    with (tmp_path / "t.csv").open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n").writerows([("a", "b"), *rows])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "ab"])
    path, split = str(tmp_path / "t.csv"), 40
    cut = records.lines(spark, path, split_bytes=split)
    assert cut.rdd.getNumPartitions() > 400
    for most in (records.MOST_BLOCKS, 0):
        got = records.read_records(spark, path, schema, split_bytes=split, most_blocks=most)
        assert [tuple(r) for r in got.orderBy("_start", "_seq").select("a", "b").collect()] == rows
        assert got.rdd.getNumPartitions() < 100


def test_same_rows_as_one_task_reading(spark, tmp_path):
    rng = random.Random(6)
    folder = tmp_path / "t.csv"
    folder.mkdir()
    cell = lambda: "".join(rng.choice(['a', 'b', '"', '\n', ',', ' ', 'é', '\r\n']) for _ in range(rng.randrange(0, 9)))
    for f in range(3):
        with (folder / f"{f}.csv").open("w", newline="", encoding="utf-8") as out:
            w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL)
            w.writerow(["k", "u", "v"])
            w.writerows([f"{f}-{i}", cell(), cell()] for i in range(400))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "kuv"])
    plain = spark.read.options(header=True, escape='"', multiLine=True, mode="FAILFAST").schema(schema).csv(str(folder))
    got = records.read_records(spark, str(folder), schema, split_bytes=1000).select("k", "u", "v")
    assert values(got, "k") == values(plain, "k") and got.count() == 1200
    spread = records.lines(spark, str(folder), split_bytes=1000)
    assert spread.rdd.getNumPartitions() > 10


def test_odd_quotes_and_ragged_records_are_errors(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="odd number of quotes in .*odd.csv"):
        readers.read_table(spark, str(tmp_path / "odd.csv"), multi_line=True).collect()
    (tmp_path / "ragged.csv").write_text('a,b\n1,"x\ny",3\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_table(spark, str(tmp_path / "ragged.csv"), multi_line=True).collect()


def test_layouts_ordinals_and_encoding_with_line_breaks(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes('id;b\n1;"é\nN/A"\n2;N/A\n'.encode("latin-1"))
    (folder / "b.csv").write_bytes('b;id\n"ü\r\nz";3\n'.encode("latin-1"))
    df = readers.read_table(spark, str(folder), ordinal=True, sep=";", encoding="ISO-8859-1", multi_line=True, split_bytes=4)
    assert [(r.id, r.b) for r in df.orderBy("_row").collect()] == [("1", "é\nN/A"), ("2", None), ("3", "ü\r\nz")]


def test_settings_and_views_of_the_session_stay(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a\n"x\ny"\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    df = readers.read_table(spark, str(tmp_path / "t.csv"), multi_line=True)
    assert df.sparkSession is spark and df.count() == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes", None) == before
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("lines_")]

