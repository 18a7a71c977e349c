"""Line dedup finds repeated passages of two lines, whatever their hashes."""

import duckdb

from covoxel.llm import lines
from covoxel.llm.queries import OP1_SQL

N = 64


def test_every_passage_of_two_lines_goes(spark, tmp_path):
    own = lambda d, i: f"line {i} of document {d} alone"
    rows = [(d, "\n".join([own(d, 0), own(d, 1), f"first {d % N}", f"second {d % N}", own(d, 2), own(d, 3)])) for d in range(2 * N)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_dedup(docs).collect()}
    assert [got[d].n_lines_removed for d in range(2 * N)] == [0] * N + [2] * N
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    twin = db.sql(OP1_SQL).fetchall()
    assert {r[0]: tuple(r) for r in twin} == {d: tuple(r) for d, r in got.items()}
