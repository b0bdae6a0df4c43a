"""From CSV to every report, on a table with the original column names."""

import pytest

from roadpulse.__main__ import main
from roadpulse.plans.reports import REPORTS
from roadpulse.sources import csv_ingest, layout, tables

NAMES = {
    "event_id": "ID",
    "severity": "Severity",
    "start_lat": "Start_Lat",
    "start_lng": "Start_Lng",
    "start_time": "Start_Time",
    "end_time": "End_Time",
    "sunrise_sunset": "Sunrise_Sunset",
    "state": "State",
    "street": "Street",
    "precipitation_in": "Precipitation(in)",
    "visibility_mi": "Visibility(mi)",
    "wind_speed_mph": "Wind_Speed(mph)",
    "temperature_f": "Temperature(F)",
    "humidity_pct": "Humidity(%)",
}


@pytest.fixture(scope="module")
def csv_path(spark, tiny, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reports") / "csv")
    incidents = tables.incidents(spark, tiny).select(*NAMES).withColumnsRenamed(NAMES)
    incidents.write.option("header", "true").csv(path)
    return path


@pytest.fixture(scope="module")
def incidents(spark, csv_path, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("reports") / "table")
    converted = csv_ingest.convert_csv(spark, csv_path, out)
    assert converted.rejects.isEmpty()
    assert converted.table.keys == layout.CLUSTER_KEYS
    return tables.read_incidents(spark, out)


def test_table_survives_the_csv(spark, tiny, incidents):
    names = [csv_ingest.snake_case(n) for n in NAMES.values()]
    want = tables.incidents(spark, tiny).withColumnRenamed("event_id", "id").select(*names)
    want = want.withColumn("id", want["id"].cast("string"))
    got = incidents.select(*names)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("report", sorted(REPORTS))
def test_report(incidents, report):
    rows = REPORTS[report](incidents).collect()
    if report == "sample":
        assert len(rows) == 5
    elif report == "nearest":
        assert len(rows) == 10 and round(rows[0]["distance_km"], 6) == 3.460691
    elif report == "in-radius":
        assert rows[0]["incidents"] == 978
    elif report == "hotspots":
        assert tuple(rows[0]) == (33.96, -118.12, 20)
    elif report == "routes":
        assert (rows[0]["route"], rows[0]["incidents"]) == ("I-5", 78)
    elif report == "clearance":
        first = [r for r in rows if (r["sunrise_sunset"], r["day_type"]) == ("Day", "weekday")][0]
        assert (round(first["mean_clearance_min"], 6), first["incidents"]) == (51.542952, 350)
    elif report == "anomaly-count":
        assert rows[0]["anomalies"] == 0


def test_command_line(spark, csv_path, tmp_path, monkeypatch, capsys):
    out = str(tmp_path / "table")
    main(["convert", csv_path, out])
    main(["routes", out])
    assert "I-5" in capsys.readouterr().out


def test_command_line_prints_every_row(spark, tmp_path, capsys):
    path = str(tmp_path / "wide")
    spark.range(3).selectExpr("id", *[f"id + {i} AS column_{i}" for i in range(45)]).write.parquet(path)
    main(["columns", path])
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 47 and out[-1].split("\t")[1] == "column_44"


def test_command_line_needs_an_output(csv_path):
    with pytest.raises(SystemExit):
        main(["convert", csv_path])
