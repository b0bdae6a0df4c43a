"""Every text query that SQL can express, against its SQL."""

import compare
import pytest

from roadpulse.llm import oracle, queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows_as_sql(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    con = compare.connect(sf_dir)
    names, rows = compare.spark_rows(queries.registered()[name](spark, sf_dir))
    want_names, want = compare.oracle_rows(con, oracle.oracle_sql()[name])
    assert names == want_names
    assert rows == want
