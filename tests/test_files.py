"""CSV scans that check the header and keep what does not parse; data sets clustered by stay."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.sources import tables


@pytest.fixture
def folder(tmp_path):
    def write(*files):
        for i, text in enumerate(files):
            (tmp_path / f"{i}.csv").write_text(text)
        return str(tmp_path)

    return write


SCHEMA = "id bigint, at timestamp, v double"


def test_scan_by_header_with_rejects(spark, folder):
    path = folder(
        "v,extra,id,at\n1.5,x,1,2024-01-01 00:00:00\nNaN,,2,\n> 3,x,3,soon\n7,x\n8,x,8,2024-01-01,9,10\n",
        'v,extra,id,at\n"2.5","a,b",x4,01.02.2024\n,,,\n',
    )
    rows, rejects = tables.scan_csv(spark, path, SCHEMA, ["dd.MM.yyyy"])
    got = {(r.id, str(r["at"]), r.v) for r in rows.collect()}
    assert rows.columns == ["id", "at", "v"] and got == {
        (1, "2024-01-01 00:00:00", 1.5), (2, "None", None), (3, "None", None), (None, "2024-02-01 00:00:00", 2.5), (None, "None", None),
    }
    lines = {(r.kind, r.line) for r in rejects.collect() if r.kind == "fields"}
    assert lines == {("fields", "7,x"), ("fields", "8,x,8,2024-01-01,9,10")}
    wrong = {(w.column, w.text) for r in rejects.collect() for w in r.wrong or []}
    assert wrong == {("v", "> 3"), ("at", "soon"), ("id", "x4")}
    assert {(r.kind, r.column, r.n) for r in tables.reject_counts(rejects).collect()} == {
        ("fields", None, 2), ("values", "v", 1), ("values", "at", 1), ("values", "id", 1)
    }
    assert all(r.file.endswith(".csv") for r in rejects.collect())


def test_scan_refuses_unknown_and_other_headers(spark, folder):
    with pytest.raises(ValueError, match="w"):
        tables.scan_csv(spark, folder("v,id,at\n1,2,\n"), SCHEMA + ", w int")
    path = folder("v,id,at\n1,2,\n", "id,v,at\n1,2,\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.scan_csv(spark, path, SCHEMA)


def test_scan_of_unnamed_and_clashing_columns(spark, folder):
    rows, rejects = tables.scan_csv(spark, folder(",_broken,id\n0,b,1\n1,b\n"), "id int, _broken string")
    assert [tuple(r) for r in rows.collect()] == [(1, "b")] and [r.line for r in rejects.collect()] == ["1,b"]
    rows, rejects = tables.scan_csv(spark, folder("id\n"), "id int")
    assert rows.collect() == [] == rejects.collect()


@pytest.fixture(scope="module")
def clustered(spark):
    rows = spark.range(20_000).select(
        (F.col("id") * 7919 % 20_000).alias("stay_id"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.sequence(F.lit(0), F.lit(9)).alias("x"),
    )
    path = session.fresh_path(spark, "clustered")
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.write_dataset({"rows": rows}, path, clustered=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
    return path


def test_a_stay_is_in_one_file(spark, clustered):
    """By the statistics that the files themselves carry, and by the plan of a lookup."""
    files = glob.glob(f"{clustered.removeprefix('file:')}/rows/split=*/*.parquet")
    assert len(files) >= 8
    spans = []
    for f in files:
        meta = pq.read_metadata(f)
        column = [meta.schema.column(i).path for i in range(meta.num_columns)].index("stay_id")
        stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
        spans.append((f.split("split=")[1].split("/")[0], min(s.min for s in stats), max(s.max for s in stats)))
    for split in ("train", "test"):
        mine = sorted(s[1:] for s in spans if s[0] == split)
        assert all(a[1] < b[0] for a, b in zip(mine, mine[1:]))
    index = spark.read.parquet(f"{clustered}/file_index").collect()
    assert all(r.in_order for r in index) and sum(r.rows for r in index) == 20_000
    one = tables.read_stays(spark, clustered, [777])
    assert [r.stay_id for r in one.collect()] == [777] and len(one.inputFiles()) <= 2
    split = one.first().split
    assert len([f for f in one.inputFiles() if f"split={split}" in f]) == 1


def test_lookup_of_absent_stays(spark, clustered):
    assert tables.read_stays(spark, clustered, [-5]).collect() == []
    some = tables.read_stays(spark, clustered, [3, 19_999, 20_001])
    assert sorted(r.stay_id for r in some.collect()) == [3, 19_999]
