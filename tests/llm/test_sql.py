"""The SQL of queries whose operators have one, against the queries, on a small table with awkward rows."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.conftest import ROWS
from tests.llm.test_operators import passages
from tidemark.llm import queries


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_suffix_array", "op9_substring_dedup"])
def test_sql(spark, tmp_path, name):
    long = [(500 + k, f"{'ab ' * 40}{k} " + "the same passage goes through many documents word by word " * 9) for k in range(6)]
    rows = [*passages(1), *long, *[r for r in ROWS if r[0] is not None]]
    if name == "op1_exact_dedup":  # its SQL tells rows of an id apart by nothing else
        rows = list({i: (i, t) for i, t in rows if i is not None}.values())
    table = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())})
    pq.write_table(table, tmp_path / "documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    want = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, f"file://{tmp_path}").select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
