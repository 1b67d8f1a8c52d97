"""The SQL twins on awkward rows: nulls, empty texts, repeated rows, texts beyond ASCII."""

import duckdb
import pytest

from logwarden.llm import queries
from logwarden.llm.oracles import ORACLES

PASSAGE = " ".join(f"w{i % 17}x{i}" for i in range(80))
TEXTS = [PASSAGE, PASSAGE.replace("w3x3", "changed"), PASSAGE.upper() + " end", "has <S> in it, and more", "Four words only here", "one two  three", "", None, " \t\n", "naïve ÉCOLE", "日本語 テキスト", "\U0001f600", "word " * 3000]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin_agrees(spark, tmp_path, name):
    rows = [(i, TEXTS[i % len(TEXTS)], ("a", "b", None, "c", "a")[i % 5]) for i in range(120)]
    rows += [(7, "same", "a"), (7, "same", "a"), (None, "without id", "b")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = ", ".join(f'"{c}"' for c in found.columns)
    wanted = con.sql(f"select {columns} from ({ORACLES[name]}) q").fetchall()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
