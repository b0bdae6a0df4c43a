"""Files that arrive, restarts in between, against the batch ingest of all of them."""

import pytest

from roadpulse.sources import csv_ingest
from roadpulse.streaming import continuous_ingest as continuous

HEADER = "ID,Severity,Start_Lat,Street"


def drop_file(folder, name, first, rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    lines = [f"{name}-{i},{i if i % 5 else 'oops'},{i}.5,Main St" if i % 7 else f"{name}-{i},1" for i in range(first, first + rows)]
    hidden = folder / f"_{name}"
    hidden.write_text("\n".join([header, *lines]) + "\n")
    hidden.rename(folder / f"{name}.csv")


def take(spark, source, out, **options):
    query = continuous.follow_csv(spark, str(source), str(out), **options)
    query.awaitTermination()
    return query


def rows(found):
    return sorted(map(tuple, found.clean.collect())), sorted(map(tuple, found.rejects.collect()))


def test_a_restart_in_mid_run_gives_the_rows_of_the_batch_form(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    for k in range(5):
        drop_file(source, f"f{k}", 10 * k, 9 + k)

    done = []

    def fail(number):
        done.append(number)
        if number == 1:
            raise RuntimeError("stopped here")

    # The second batch is written and then fails before it is committed.
    with pytest.raises(Exception, match="stopped here"):
        take(spark, source, out, files_per_batch=2, before_commit=fail)
    assert done == [0, 1]
    drop_file(source, "late [x] {1}", 1, 12)
    done.clear()
    take(spark, source, out, files_per_batch=2, before_commit=done.append)
    assert done[0] == 1 and len(done) >= 2
    want = rows(csv_ingest.ingest_csv(spark, str(source)))
    assert rows(continuous.taken_in(spark, str(out))) == want
    assert len(want[0]) > 20 and len(want[1]) > 10
    done.clear()
    take(spark, source, out, before_commit=done.append)
    assert done == []
    assert rows(continuous.taken_in(spark, str(out))) == want


def test_what_a_dead_try_left_is_replaced(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    drop_file(source, "a", 1, 4)
    left = tmp_path / "out" / "rows" / "batch=0"
    csv_ingest.stage_csv(spark, str(source), str(left))
    take(spark, source, out)
    assert rows(continuous.taken_in(spark, str(out))) == rows(csv_ingest.ingest_csv(spark, str(source)))


def test_empty_files_and_other_columns(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    drop_file(source, "a", 1, 3)
    take(spark, source, out)
    (source / "empty.csv").write_text("\n")
    take(spark, source, out)
    drop_file(source, "b", 1, 3, header="Street,ID,Start_Lat,Severity")
    take(spark, source, out)
    assert set(continuous.taken_in(spark, str(out)).clean.columns) == {"id", "severity", "start_lat", "street"}
    drop_file(source, "c", 1, 3, header="ID,Severity,Start_Lat,Road")
    with pytest.raises(Exception, match="other columns"):
        take(spark, source, out)
    assert continuous.taken_in(spark, str(out)).clean.count() == 3


def test_names_are_streamed_and_not_contents(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    drop_file(source, "a", 1, 3)
    query = take(spark, source, out)
    plan = query._jsq.explainInternal(False)
    assert "content" not in plan.split("FileScan binaryFile")[-1].split("ReadSchema")[-1]
