"""Texts, not their words, are shuffled where words are collected by document or line."""

import pytest

from docengine import queries as Q


@pytest.mark.parametrize("name", ["words_lines", "words_group_lines", "words_exploded"])
def test_words_are_not_shuffled(spark, tmp_path, name):
    texts = [(1, "a b\nc  d\n\n e"), (2, None), (3, ""), (3, "x y\nz"), (None, "n m")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = getattr(Q, name)(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert Q.words_lines(spark, str(tmp_path)).count() == 6
