"""Rounds of the components leave nothing behind that grows with their number."""

from docengine.llm.components import components


def test_components_keep_the_size_estimate(spark):
    chain = spark.range(300).selectExpr("id AS c1", "id + 1 AS c2")
    got = components(chain)
    assert {(r["id"], r["comp"]) for r in got.collect()} == {(k, 0) for k in range(301)}
    # The estimate was multiplied by each join of each round, to thousands of digits.
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 40


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "c1 long, c2 long")).collect() == []
