"""Words of long lines and of texts that share a doc_id."""

import duckdb

from docengine import queries as Q
from docengine.oracles import ORACLES


def test_long_lines_and_shared_ids(spark, tmp_path):
    # place * x goes beyond 32 bits from some 14,700 words in a line.
    texts = [(1, " ".join(["w"] * 20000)), (2, "a b\nc  d\n\n e"), (3, "x y\nz"), (3, ""), (3, "n\n\nm o"), (4, None), (5, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = Q.words_exploded(spark, str(tmp_path))
    got = {r["doc_id"]: tuple(r) for r in found.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {r[0]: tuple(map(int, r)) for r in con.sql(ORACLES["words_exploded"]).fetchall()}
    # Words at one place of several texts all start their line, so every order of them weighs the same.
    assert got == want and got[3][1:4] == (8, 7, 100)
    assert "Sort [" not in found._jdf.queryExecution().executedPlan().toString()
