"""The SQL of the quality rules on lines that tell one rule from another."""

import random

import compare
import duckdb

from helpers import prose
from roadpulse.llm import oracle
from roadpulse.llm.quality_rules import clean_lines

COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words", "base_failed", "kept",
]


def cases():
    rng = random.Random(11)
    few = prose(5, 400).split()
    block = [rng.choice(few) for _ in range(1000)]
    varied = " ".join(rng.choice(few) for _ in range(2500))
    clean = prose(6, 40)
    return {
        1: clean + " Powered By " + prose(7, 30),
        2: clean + "\nclick here privacy policy today please now\n" + prose(8, 30),
        3: clean + "\none two three four five six click here\nsix five four three two one more click here",
        4: varied,
        5: " ".join(block * 3),
        6: " ".join(few[:150] * 20),
        7: clean + "\n" + varied + "\n" + " ".join(block * 3),
        8: "home | about | news | help\n" + clean + "\n" + clean,
        9: None,
        10: "",
        11: "ab " * 7 + "\n" + "ab " * 8 + "\n" + prose(9, 30),
    }


def test_same_rows_as_sql_on_lines_that_differ_by_rule(spark, tmp_path):
    docs = spark.createDataFrame(list(cases().items()), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    found = compare.spark_rows(clean_lines(docs, carry=["doc_id"], with_text=False).select(*COLUMNS))
    assert found == compare.oracle_rows(con, oracle.oracle_sql()["op6_quality_rules"])

    lost = {r["doc_id"]: r["n_lost_words"] for r in clean_lines(docs, carry=["doc_id"]).collect()}
    assert lost[1] == 0 and lost[2] == 7 and lost[3] == 8
    assert lost[4] == 0 and lost[5] == 3000 and lost[6] == 3000 and lost[7] == 3000
