"""Files bound by their headers, nothing lost, types that widen, each file once."""

import json

import pytest
from pyspark.sql import functions as F

from dqlake.sources import (
    bind, bindings, header_drift, header_lines, ingest_feed, known_types, merged_types, observe_types, read_feed,
    read_lines, read_snapshot, rescue, type_drift, typed_feed,
)
from dqlake.sources.delimited import FILE

COLUMNS = ("id", "name", "age")

@pytest.fixture
def as_of(spark):
    return F.lit("2024-06-30").cast("date")


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def table(df):
    return {r.id: (r.name, r.age, json.loads(r._rescued_data) if r._rescued_data else None) for r in df.collect()}


def test_columns_are_bound_by_each_files_header(spark, as_of, tmp_path):
    put(tmp_path, "a.csv", "id,name,age\n1,ann,30\n")
    put(tmp_path, "b.csv", "AGE, Name ,id\n31,bob,2\n")
    put(tmp_path, "c.csv", "id,city,name\n3,Rome,cyd\n")
    put(tmp_path, "d.csv", "﻿id,name,age,id\n4,dan,33,44\n")
    got = table(read_snapshot(spark, str(tmp_path), COLUMNS, as_of))
    assert got == {"1": ("ann", "30", None), "2": ("bob", "31", None), "3": ("cyd", None, {"city": "Rome"}),
                   "4": ("dan", "33", {"#4": "44"})}
    drift = header_drift(bindings(header_lines(spark, str(tmp_path)), COLUMNS), COLUMNS)
    found = {r[FILE][-5:]: (r.missing_columns, r.unknown_columns, r.reordered) for r in drift.collect()}
    assert found == {"b.csv": ("", "", True), "c.csv": ("age", "city", False), "d.csv": ("", "#4", False)}


@pytest.mark.parametrize("line, want", [
    ('1,"a ""b"", c",5', ("1", 'a "b", c', "5", None)),
    ("1,,", ("1", None, None, None)),
    ("1", ("1", None, None, None)),
    ('1,"",5', ("1", "", "5", None)),
    ('1,5" pipe,7', ("1", '5" pipe', "7", None)),
    (" 1 , x ,", (" 1 ", " x ", None, None)),
    ("1,a,5,more,", ("1", "a", "5", {"#4": "more", "#5": ""})),
    ('1,"open,5', (None, None, None, {"_line": '1,"open,5'})),
    ('1,"a"b,5', (None, None, None, {"_line": '1,"a"b,5'})),
    ('1,é日本,"x\\"', ("1", "é日本", "x\\", None)),
    ("id,name,age", ("id", "name", "age", None)),
])
def test_no_byte_of_a_line_is_lost(spark, as_of, tmp_path, line, want):
    put(tmp_path, "a.csv", f"id,name,age\n{line}\n")
    r = read_snapshot(spark, str(tmp_path), COLUMNS, as_of).first()
    assert (r.id, r.name, r.age, json.loads(r._rescued_data) if r._rescued_data else None) == want


def test_odd_files(spark, as_of, tmp_path):
    """Empty file, header alone, blank lines, Windows line ends, a header that knows nothing, a long line."""
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "bare.csv", "id,name,age\n")
    put(tmp_path, "dos.csv", "id,name,age\r\n1,a,2\r\n\r\n2,b,3")
    put(tmp_path, "other.csv", "x,#1,_line\n7,8,9\n")
    put(tmp_path, "long.csv", "id,name,age\n9," + "n" * 300_000 + ",4\n")
    rows = read_snapshot(spark, str(tmp_path), COLUMNS, as_of).collect()
    got = {(r.id, len(r.name or ""), r.age, r._rescued_data) for r in rows}
    assert got == {("1", 1, "2", None), ("2", 1, "3", None), (None, 0, None, '{"x":"7","#2":"8","#3":"9"}'), ("9", 300_000, "4", None)}


def test_a_line_without_its_header_is_kept(spark, tmp_path):
    put(tmp_path, "a.csv", "id,name,age\n1,a,2\n")
    lines = read_lines(spark.read, str(tmp_path)).withColumn(FILE, F.lit("elsewhere"))
    got = bind(lines, bindings(header_lines(spark, str(tmp_path)), COLUMNS), COLUMNS).first()
    assert got.id is None and json.loads(got._rescued_data) == {"_line": "1,a,2"}


def test_feed_takes_each_file_once_and_widens_types(spark, as_of, tmp_path):
    landing, sink, seen, offsets = (str(tmp_path / d) for d in ("landing", "sink", "seen", "offsets"))

    def run():
        ingest_feed(spark, landing, ("id", "name", "age", "day"), sink, offsets, as_of, {"age": "int"}, observe=seen, max_files=1)

    (tmp_path / "landing").mkdir()
    run()
    assert read_feed(spark, sink, ("id", "age"), {"age": "int"}).count() == 0
    put(tmp_path / "landing", "f_1.csv", "id,name,age,day\n1,5,30,2024-01-05\n")
    run()
    assert known_types(spark, seen) == {"id": "int", "name": "int", "day": "date"}
    put(tmp_path / "landing", "f_2.csv", "day,age,name,id\n2024-01-05 10:00:00,old,2.5,3000000000\n,31,7,4\n")
    run()
    assert known_types(spark, seen) == {"id": "bigint", "name": "double", "day": "timestamp"}
    put(tmp_path / "landing", "f_3.csv", "id,name,age,day\nx-1,,32,\n")
    run()
    run()
    assert known_types(spark, seen) == {"id": "string", "name": "double", "day": "timestamp"}
    typed = typed_feed(spark, sink, seen)
    assert dict(typed.dtypes)["name"] == "double" and dict(typed.dtypes)["day"] == "timestamp"
    got = {r.id: (r.name, r.age, r._rescued_data) for r in typed.collect()}
    assert got == {"1": (5.0, 30, None), "3000000000": (2.5, None, '{"age":"old"}'), "4": (7.0, 31, None), "x-1": (None, 32, None)}


def test_a_replayed_batch_replaces_itself(spark, as_of, tmp_path):
    import shutil

    landing, sink, offsets = (str(tmp_path / d) for d in ("landing", "sink", "offsets"))
    put(tmp_path / "landing", "f_1.csv", "id,name,age\n1,a,3\n2,b,4\n")
    ingest_feed(spark, landing, COLUMNS, sink, offsets, as_of)
    # as after a failure between the write and its commit
    shutil.rmtree(f"{offsets}/commits")
    ingest_feed(spark, landing, COLUMNS, sink, offsets, as_of)
    assert read_feed(spark, sink, COLUMNS).count() == 2


def test_type_drift_counts_contradictions(rows):
    df = rows("file string, v string, w string", ("1", "1", None), ("1", "-2", None), ("2", "3000000000", "true"), ("2", "4", "FALSE"),
              ("3", "x", "1"), ("3", None, None), ("4", "1.5", ""), ("4", "+.5e3", None))
    got = {(r.file, r.column_name): (r.delivery_type, r.known_type, r.merged_type, r.contradictions)
           for r in type_drift(observe_types(df, ["v", "w"], "file"), "file").collect()}
    assert got == {
        ("1", "v"): ("int", "void", "int", 0), ("2", "v"): ("bigint", "int", "bigint", 1), ("3", "v"): ("string", "bigint", "string", 1),
        ("4", "v"): ("double", "string", "string", 0), ("1", "w"): ("void", "void", "void", 0),
        ("2", "w"): ("boolean", "void", "boolean", 0), ("3", "w"): ("int", "boolean", "string", 1), ("4", "w"): ("string", "string", "string", 0)}


def test_merged_types_do_not_depend_on_order(rows):
    values = ["2024-01-05", "2024-01-05T10:00:00", "2024-02-30", "12", "99999999999", "1e400", "2147483648", None, "true"]
    seen = observe_types(rows("file string, v string", *[(str(i), v) for i, v in enumerate(values)]), ["v"], "file")
    for picked, want in ((["0", "1"], "timestamp"), (["0", "2"], "string"), (["3", "4"], "bigint"), (["3", "5"], "double"),
                         (["3", "6"], "bigint"), (["7"], "void"), (["7", "8"], "boolean"), (["0", "3"], "string")):
        assert merged_types(seen.where(F.col("file").isin(picked))).first().type == want


def test_rescue_keeps_what_was_rescued_before(rows):
    df = rows("a string, _rescued_data string", ("1", None), ("x", None), ("y", '{"#3":"z"}'), ("2", '{"#3":"z"}'))
    assert [tuple(r) for r in rescue(df, {"a": "int"}).collect()] == [
        (1, None), (None, '{"a":"x"}'), (None, '{"#3":"z","a":"y"}'), (2, '{"#3":"z"}')]
