"""Source / sink helpers on small inputs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rsvpflow.session import work_dir
from rsvpflow.sources import sinks as SK
from rsvpflow.sources import tables as T


def test_profile_lengths_and_empty_column(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, "abcdefghij", None)], "id long, s string, e string")
    rows = {r["column_name"]: r for r in T.column_profile(df).collect()}
    assert rows["s"]["max_len"] == 10 and rows["s"]["suggested_len"] == 65  # int(1.5*10)+50
    assert rows["e"]["max_len"] is None and rows["e"]["suggested_len"] == 255
    assert rows["id"]["sql_type"] == "INT" and rows["id"]["suggested_len"] is None
    long = spark.createDataFrame([("x" * 700,)], "s string")
    assert T.column_profile(long).first()["suggested_len"] == 1000


def test_clean_headers_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        T.clean_headers(df)


def test_read_json_with_schema(spark):
    path = work_dir(spark, "json")
    os.makedirs(path)
    with open(f"{path}/part.json", "w") as f:
        for r in ({"k": "a", "n": 1}, {"k": "b"}, {"bad": True}):
            f.write(json.dumps(r) + "\n")
    df = T.read_file(spark, path, "json", schema="k string, n long")
    assert sorted(tuple(r) for r in df.filter(F.col("k").isNotNull()).collect()) == [("a", 1), ("b", None)]


def test_evolve_schema_adds_only_missing(spark):
    tgt = spark.createDataFrame([(1, "x")], "ID long, Name string")
    src = spark.createDataFrame([(2, "y", 3.5)], "id long, name string, score double")
    out = T.evolve_schema(tgt, src)
    assert out.columns == ["ID", "Name", "score"]
    assert out.schema["score"].dataType.simpleString() == "double"


def test_export_report_roundtrip_keeps_null_vs_empty(spark):
    df = spark.createDataFrame([("", None, " pad ")], "a string, b string, c string")
    path = work_dir(spark, "report")
    SK.export_report(df, path)
    back = T.read_file(spark, path, "csv", schema=df.schema).first()
    assert tuple(back) == ("", None, " pad ")


def test_table_name_fallback(spark):
    import pytest

    from rsvpflow.session import work_dir
    from rsvpflow.sources.tables import read_table_any

    base = work_dir(spark, "names")
    spark.range(3).write.parquet(f"{base}/tax_persons_analysis.parquet")
    assert read_table_any(spark, base, ["Tax_Persons_Analysis", "tax_persons_analysis"]).count() == 3
    with pytest.raises(FileNotFoundError):
        read_table_any(spark, base, ["other"])


def test_load_and_sync_resolves_names_without_case(spark):
    from rsvpflow.plans.jobs import load_and_sync

    target = spark.createDataFrame([("A", 1, "old")], "client_name string, row_no long, v string")
    raw = spark.createDataFrame([("a", 2, "new"), ("B", 3, "b")], "`Client Name` string, `Row No` long, V string")
    res, counts = load_and_sync(spark, raw, target, "Client Name", "Row No", "upsert", case_insensitive=True)
    assert res.columns == target.columns and sorted(map(tuple, res.collect())) == [("A", 2, "new"), ("B", 3, "b")]
    _, counts = load_and_sync(spark, raw, target, "Client Name", "Row No", "insert", case_insensitive=True)
    assert {r["action"]: r["row_count"] for r in counts.collect()} == {"inserted": 1, "ignored": 1}
