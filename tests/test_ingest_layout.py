import glob
import os
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadpulse.sources import csv_ingest, layout, shared_dir, tables


def test_snake_case():
    names = ["Start_Lat", "Wind_Speed(mph)", "Precipitation(in)", "Temperature(F)", "Humidity(%)", "ID"]
    want = ["start_lat", "wind_speed_mph", "precipitation_in", "temperature_f", "humidity_pct", "id"]
    assert [csv_ingest.snake_case(n) for n in names] == want


def _csv(tmp_path, name, *lines, end="\n"):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(end.join(lines).encode())
    return str(folder)


HEADER = "ID,Severity,Start_Lat,Humidity(%),Street,Start_Time"


def test_csv_rows_and_rejects(spark, tmp_path):
    path = _csv(
        tmp_path,
        "a.csv",
        HEADER,
        'A-1,3,34.5,50,"I-5, North",2016-02-08 05:46:00',
        "A-2,2,N/A,NaN,null,",
        'A-3,2,1e1, 7 ,"say ""hi""",x',
        "A-4,2,34.5",
        "A-5,2,34.5,50,Main St,x,surplus",
        "A-6,two,34.5,50,Main St,x",
        "A-7,2,34.5d,0x1p3,Main St,x",
        "A-8,1.5,1,1,Main St,x",
        "",
        "A-9,4,inf,-1.#IND,n/a,NA",
    )
    _csv(tmp_path, "b.csv", "﻿" + HEADER, "B-1,1,1,2,s,t", end="\r\n")
    clean, rejects = csv_ingest.ingest_csv(spark, path)
    assert dict(clean.dtypes) == {
        "id": "string",
        "severity": "bigint",
        "start_lat": "double",
        "humidity_pct": "double",
        "street": "string",
        "start_time": "string",
    }
    got = {r["id"]: tuple(r)[1:] for r in clean.collect()}
    assert got == {
        "A-1": (3, 34.5, 50.0, "I-5, North", "2016-02-08 05:46:00"),
        "A-2": (2, None, None, None, None),
        "A-3": (2, 10.0, 7.0, 'say "hi"', "x"),
        "A-9": (4, float("inf"), None, None, None),
        "B-1": (1, 1.0, 2.0, "s", "t"),
    }
    bad = {r["line"].split(",")[0]: r["reject_reason"] for r in rejects.collect()}
    assert bad == {
        "A-4": "field_count",
        "A-5": "field_count",
        "A-6": "bad_value:Severity",
        "A-7": "bad_value:Start_Lat,Humidity(%)",
        "A-8": "bad_value:Severity",
    }
    # Counting reads no value column; the broken lines must not come back for it.
    assert (clean.count(), rejects.count()) == (5, 5)
    assert clean.select("id").count() == 5


def test_headers_are_known_when_files_are_dealt_anew(spark, tmp_path):
    """Between finding the headers and reading the rows, as when executors come or go."""
    for k in range(6):
        path = _csv(tmp_path, f"{k}.csv", "ID,Severity", *[f"{k}-{i},{i}" for i in range(3 + k)])
    want = sorted((f"{k}-{i}", i) for k in range(6) for i in range(3 + k))
    try:
        clean, rejects = csv_ingest.ingest_csv(spark, path)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert sorted(map(tuple, clean.collect())) == want
        assert rejects.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_helper_names_do_not_clash(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", "line,reject_reason,p,c0,Severity", "a,b,c,d,1", "a,b,c,d,x")
    clean, rejects = csv_ingest.ingest_csv(spark, path)
    assert [tuple(r) for r in clean.collect()] == [("a", "b", "c", "d", 1)]
    assert [tuple(r) for r in rejects.collect()] == [("a,b,c,d,x", "bad_value:Severity")]


def test_text_only_table(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", "a,b", "1,2", "1", "1,2,3")
    clean, rejects = csv_ingest.ingest_csv(spark, path, types={})
    assert (clean.count(), rejects.count()) == (1, 2)


def test_inferred_types_fit_every_value(spark, tmp_path):
    rows = [f"{i},{i}.5,true,2024-01-0{i},2024-01-01 00:00:0{i},{i},," for i in range(1, 9)]
    late = "9,N/A,False,,NA,nine,,"
    path = _csv(tmp_path, "a.csv", "i,f,b,d,t,s,Start_Lat,empty", *rows, late)
    clean, rejects = csv_ingest.ingest_csv(spark, path, infer=True)
    assert dict(clean.dtypes) == {
        "i": "bigint",
        "f": "double",
        "b": "boolean",
        "d": "date",
        "t": "timestamp_ntz",
        "s": "string",
        "start_lat": "double",
        "empty": "string",
    }
    assert clean.count() == 9 and rejects.isEmpty()


def test_missing_and_empty_input(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_ingest.ingest_csv(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no header"):
        csv_ingest.ingest_csv(spark, _csv(tmp_path, "empty.csv", ""))


def test_each_line_is_parsed_once(spark, tiny):
    clean, _ = csv_ingest.ingest_lines(
        tables.event_csv_lines(spark, tiny), tables.EVENT_CSV_COLUMNS, tables.EVENT_CSV_TYPES
    )
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1


def _files(path):
    return sorted(glob.glob(os.path.join(path, "*.parquet")))


def _bounds(path, keys):
    """First and last key of every file, nulls before everything."""
    found = []
    for f in _files(path):
        rows = pq.read_table(f, columns=list(keys)).to_pylist()
        order = [tuple((r[k] is not None, r[k]) for k in keys) for r in rows]
        assert order == sorted(order)
        found.append((order[0], order[-1]))
    return sorted(found)


def test_clustered_layout(spark, small, tmp_path):
    df = tables.incidents(spark, small)
    table = layout.write_clustered(df, str(tmp_path / "t"), partitions=6, rows_per_group=500)
    assert layout.read_clustered(spark, table).exceptAll(df).isEmpty()
    assert df.exceptAll(layout.read_clustered(spark, table)).isEmpty()
    bounds = _bounds(table.path, table.keys)
    assert len(bounds) >= 5
    assert all(last <= first for (_, last), (first, _) in zip(bounds, bounds[1:]))
    for f in _files(table.path):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            assert group.num_rows <= 500
            state = group.column(df.columns.index("state"))
            assert state.compression == "ZSTD"
            assert any("DICTIONARY" in e for e in state.encodings)
            # A group of nothing but null states has no bounds to show.
            assert state.statistics.null_count == group.num_rows or state.statistics.has_min_max
    zones = layout.zone_map(spark, table).collect()
    assert len(zones) == len(bounds) and sum(z["rows"] for z in zones) == 10_000


def test_partitions_follow_from_rows(spark, small, tmp_path):
    df = tables.incidents(spark, small)
    table = layout.write_clustered(df, str(tmp_path / "t"), rows_per_file=2_500)
    assert 3 <= len(_files(table.path)) <= 4


def test_hot_key_covers_many_files(spark, tmp_path):
    """Half of the table under one key, and all of that in identical copies."""
    src = str(tmp_path / "src")
    rows = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") < 10_000, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("state"),
        F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("v"),
    )
    rows.write.parquet(src)
    table = layout.cluster_parquet(spark, src, str(tmp_path / "t"), ["state"], partitions=10)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in _files(table.path)]
    assert sum(sizes) == 20_000
    assert max(sizes) < 6_000 and len(sizes) >= 8
    back = layout.read_clustered(spark, table)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_convert_csv(spark, tmp_path):
    lines = [f"A-{i},{1 + i % 4},{34 + i / 100},50,St {i % 7},2024-01-01" for i in range(200)]
    path = _csv(tmp_path, "a.csv", HEADER, *lines, "broken,line")
    converted = csv_ingest.convert_csv(spark, path, str(tmp_path / "out"), partitions=3)
    assert converted.table.keys == ("start_lat", "street")
    table = layout.read_clustered(spark, converted.table)
    assert table.columns == ["id", "severity", "start_lat", "humidity_pct", "street", "start_time"]
    assert table.count() == 200
    assert [tuple(r) for r in converted.rejects.collect()] == [("broken,line", "field_count")]
    bounds = _bounds(converted.table.path, converted.table.keys)
    assert all(last <= first for (_, last), (first, _) in zip(bounds, bounds[1:]))


def test_files_with_columns_in_another_order(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", "Start_Lat,Start_Lng,Street", "1,2,a", "Start_Lat,Start_Lng,Street", "3,4,b")
    _csv(tmp_path, "b.csv", "", "Street,Start_Lng,Start_Lat", "c,20,10")
    clean, rejects = csv_ingest.ingest_csv(spark, path)
    assert sorted(map(tuple, clean.collect())) == [(1.0, 2.0, "a"), (3.0, 4.0, "b"), (10.0, 20.0, "c")]
    # Further down, a line equal to the header is a line like others.
    assert [tuple(r) for r in rejects.collect()] == [("Start_Lat,Start_Lng,Street", "bad_value:Start_Lat,Start_Lng")]


def test_files_with_other_columns_are_refused(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", "a,b", "1,2")
    _csv(tmp_path, "b.csv", "a,c", "1,2")
    with pytest.raises(ValueError, match="differ in their columns"):
        csv_ingest.ingest_csv(spark, path)


def test_a_table_without_keys_is_converted(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", "a,b", "1,x", "2,y", "3")
    converted = csv_ingest.convert_csv(spark, path, str(tmp_path / "out"), infer=True)
    assert converted.table.keys == ()
    table = layout.read_clustered(spark, converted.table)
    assert dict(table.dtypes) == {"a": "bigint", "b": "string"}
    assert sorted(map(tuple, table.collect())) == [(1, "x"), (2, "y")]
    assert converted.rejects.count() == 1
    shared_dir.remove_path(spark, converted.staged)
    assert not os.path.exists(converted.staged.removeprefix("file:"))


def test_order_check_sees_disorder(spark, small, tmp_path):
    df = tables.incidents(spark, small)
    good = layout.write_clustered(df, str(tmp_path / "good"), partitions=4)
    row = layout.order_check(spark, good).first()
    assert (row["rows"], row["rows_out_of_order"], row["files_overlapping"]) == (10_000, 0, 0)
    df.repartition(4, "event_id").write.parquet(str(tmp_path / "bad"))
    row = layout.order_check(spark, layout.ClusteredTable(str(tmp_path / "bad"), layout.CLUSTER_KEYS)).first()
    assert row["rows_out_of_order"] > 1000 and row["files_overlapping"] == 3


def test_incident_table_with_original_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "`Severity` long, `Humidity(%)` double")
    df.write.parquet(str(tmp_path / "t"))
    assert tables.read_incidents(spark, str(tmp_path / "t")).columns == ["severity", "humidity_pct"]


def test_scratch_paths_are_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = (shared_dir.scratch_path(spark, "x") for _ in range(2))
    assert one.startswith(base) and one != two


def _session_with(**settings):
    named = {k.replace("_", "."): v for k, v in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named.get(key, default)))


def test_scratch_paths_without_a_checkpoint_folder_are_in_the_warehouse():
    path = shared_dir.scratch_path(_session_with(spark_checkpoint_dir="hdfs://name/shared/"), "x")
    assert path.startswith("hdfs://name/shared/x-")
    with_warehouse = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *d: {"spark.sql.warehouse.dir": "hdfs://name/w"}.get(key, *d)))
    assert shared_dir.scratch_path(with_warehouse, "x").startswith("hdfs://name/w/x-")
