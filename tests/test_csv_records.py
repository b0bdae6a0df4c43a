"""Records over several lines, against a plain reader, however the files are split."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.sources import csv_ingest, csv_records

FIELDS = ["", "a", "plain text", 'say "hi"', "two\nlines", "\n\nthree\r\nmore, with commas\n", '"', '""', 'x"y', "é中😀\n", ",", "\n", 'end"\n"start']


def written_file(folder, name, seed, rows, ending="\n", bom=False, long=False):
    """A file with quotes where they are needed, at random elsewhere, and stray quotes inside plain fields."""
    rng = random.Random(seed)
    out = ["﻿" * bom + "id,one,two"]
    for i in range(rows):
        record = [f"{name}{i}"]
        for _ in range(2):
            value = rng.choice(FIELDS) * (rng.choice([1, 1, 1, 60]) if long else 1)
            if '"' in value[:1] or any(c in value for c in ',\n\r') or rng.random() < 0.2:
                record.append('"' + value.replace('"', '""') + '"')
            else:
                record.append(value)
        out.append(",".join(record))
        if rng.random() < 0.1:
            out.append("")
    text = ending.join(out) + ending * rng.randint(0, 2)
    (folder / f"{name}.csv").write_bytes(text.encode())
    return text


def plain(text):
    return [tuple(r) for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r][1:]


@pytest.mark.parametrize("line", ['a,"b', 'a,"b"', 'a,"b""', '"""', '""""', 'x"y', 'x",y"', '"a"b,"c', ',,"', '"', "", '"a",'])
def test_state_after_a_line_is_that_of_a_plain_reader(line):
    def goes_on(text):
        return len(list(csv.reader(io.StringIO(text + "\nZ\n", newline="")))) == 1

    assert csv_records.ends_inside(line, False) == goes_on(line)
    assert csv_records.ends_inside(line, True) == goes_on('"begun\n' + line)


@pytest.mark.parametrize(("split_bytes", "rows"), [(9, 3), (23, 8), (150, 30), (600, 60), (1 << 20, 60)])
def test_records_at_every_split_size(spark, tmp_path, split_bytes, rows):
    texts = [
        written_file(tmp_path, "a", 1, rows, long=rows > 8),
        written_file(tmp_path, "b", 2, rows, ending="\r\n", bom=True),
        written_file(tmp_path, "c", 3, 0),
        written_file(tmp_path, "d", 4, rows // 2),
    ]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        found, heads = csv_records.read_records(spark, str(tmp_path))
        assert set(heads.values()) == {"id,one,two"} and len(heads) == 4
        got = [list(csv.reader(io.StringIO(r["value"], newline=""))) for r in found.collect()]
        assert {len(r) for r in got} == {1}
        got = sorted(tuple(r[0]) for r in got)
        clean, rejects = csv_ingest.ingest_csv(spark, str(tmp_path), {}, multiline=True)
        typed = sorted(tuple(r) for r in clean.collect())
        assert rejects.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted(r for t in texts for r in plain(t))
    assert got == want
    assert typed == [tuple(None if v in csv_ingest.NULL_TOKENS else v for v in r) for r in want]


def test_line_breaks_reject_without_multiline(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Severity,text\n1,2,"two\nlines"\n2,x,"a\n\nb"\n3,4,c\n')
    clean, rejects = csv_ingest.ingest_csv(spark, str(tmp_path), multiline=True)
    assert sorted(tuple(r) for r in clean.collect()) == [("1", 2, "two\nlines"), ("3", 4, "c")]
    assert [tuple(r) for r in rejects.collect()] == [('2,x,"a\n\nb"', "bad_value:Severity")]
    clean, rejects = csv_ingest.ingest_csv(spark, str(tmp_path))
    assert "3" in {r["id"] for r in clean.collect()}
    assert 'lines"' in {r["line"] for r in rejects.collect()}


def test_headers_of_several_lines_and_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n"id\nkey",n\nx,1\n')
    (tmp_path / "b.csv").write_text('n,"id\nkey"\n2,"y\nz"\n')
    clean, _ = csv_ingest.ingest_csv(spark, str(tmp_path), {"n": "bigint"}, multiline=True)
    assert sorted(map(tuple, clean.select("id_key", "n").collect())) == [("x", 1), ("y\nz", 2)]


def test_a_field_that_is_never_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,a\n2,"open\nto the end\n')
    rows, _ = csv_records.read_records(spark, str(tmp_path))
    assert sorted(r["value"] for r in rows.collect()) == ["1,a", '2,"open\nto the end']


def test_converted_with_line_breaks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = written_file(tmp_path / "in", "a", 5, 80)
    done = csv_ingest.convert_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), ("id",), {}, multiline=True, partitions=2)
    got = sorted(tuple(r) for r in spark.read.parquet(done.table.path).collect())
    assert got == sorted(tuple(None if v in csv_ingest.NULL_TOKENS else v for v in r) for r in plain(text))


def test_files_split_anew_are_noticed(spark, tmp_path):
    written_file(tmp_path, "a", 1, 60)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows, _ = csv_records.read_records(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        with pytest.raises(Exception, match="split anew"):
            rows.select(F.max("value")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_input(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        csv_ingest.ingest_csv(spark, str(tmp_path), multiline=True)
