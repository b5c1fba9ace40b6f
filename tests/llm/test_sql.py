"""Queries against their SQL in DuckDB: at the small scale, and on rows of every edge case."""

import duckdb
import pytest
from rows import SF_SMALL as SF

from lakeledger.llm.queries import ORACLE, QUERIES


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def both(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet/*.parquet')"
                    if sf_dir != SF else f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    wanted = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    return in_order(got.collect()), in_order(wanted)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    got, wanted = both(spark, SF, name)
    assert got and got == wanted


def turns():
    said = "<|turn|>a<|text|><-<--</s>"
    return [
        (1, None, None, None), (1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", "x<"), (1, 2, "assistant", "-y"),
        (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 5, "", "é\U0001F600" * 20_000), (4, 0, "assistant", None),
        (5, 1, "user", "same"), (5, 1, "user", "same"), (5, 1, "assistant", "same"),
    ]


@pytest.fixture
def edge_dir(spark, edge_docs, tmp_path):
    edge_docs.dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_edge_rows_equal_the_sql(spark, edge_dir, name):
    got, wanted = both(spark, edge_dir, name)
    assert got and got == wanted
