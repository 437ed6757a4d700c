"""Crowded pages against the plain fold, and the label index against the search word by word."""

import random
import time

from pyspark.sql import functions as F

from docengine.functions import fields, labels as L
from docengine.functions.labelindex import LabelIndex
from docengine.operators import geometry as G, words as W
from docengine.plans import records as R


def frame(spark, boxes):
    return spark.createDataFrame([("p", *b) for b in boxes] + [(None, 1, 1, 5, 5), (None, 2, 2, 5, 5)], "page string, x int, y int, w int, h int")


def kept(boxes, t):
    out = []
    for b in sorted(boxes):
        if not any(all(abs(i - j) < t for i, j in zip(b, k)) for k in out):
            out.append(b)
    return out


def free(boxes, margin, ratio):
    def inside(a, b):
        return a[0] >= b[0] + margin and a[1] >= b[1] + margin and a[0] + a[2] <= b[0] + b[2] - margin and a[1] + a[3] <= b[1] + b[3] - margin and a[2] * a[3] / max(1, b[2] * b[3]) <= ratio

    return [a for a in boxes if not any(inside(a, b) for b in boxes)]


def test_crowded_pages_equal_the_fold(spark, monkeypatch):
    draw = random.Random(3)
    boxes = [(draw.randrange(300), draw.randrange(300), draw.choice([5, 20, 21, 90, 260]), draw.choice([5, 20, 22, 90, 260])) for _ in range(500)]
    boxes += boxes[:20] + [(-7, -9, 400, 400), (0, 0, 0, 0), (1 << 20, 5, 9, 9)]
    table = frame(spark, boxes)
    for crowded in (1, 10_000):
        monkeypatch.setattr(G, "CROWDED", crowded)
        for t in (1, 4, 12):
            got = G.dedupe(table, ["page"], t)
            assert sorted(tuple(r)[1:] for r in got.where("page = 'p'").collect()) == sorted(kept(boxes, t))
            assert got.where("page is null").count() == (2 if t == 1 else 1)
        got = G.remove_contained(table, ["page"], 1, 0.9)
        assert sorted(tuple(r)[1:] for r in got.where("page = 'p'").collect()) == sorted(free(boxes, 1, 0.9)) and got.where("page is null").count() == 2


def test_a_page_of_twenty_thousand_boxes(spark):
    draw = random.Random(4)
    boxes = [(draw.randrange(4000), draw.randrange(4000), draw.randrange(1, 60), draw.randrange(1, 60)) for _ in range(20_000)]
    table = frame(spark, boxes)
    began = time.time()
    n_kept, n_free = G.dedupe(table, ["page"]).count(), G.remove_contained(table, ["page"]).count()
    assert 0 < n_kept <= 20_002 and 0 < n_free <= 20_002 and time.time() - began < 120


VARIANTS = {"a": ["name", "full name", "nm"], "b": ["house no", "no"], "c": ["one two three", "two"], "d": ["zz top"]}


def test_label_index_equals_the_search_word_by_word(spark):
    draw = random.Random(6)
    pool = ["name", "full", "nam", "house", "no", "houseno", "one", "two", "three", "onetwo", "x", "zz", "top", "-", "", "name:", "TWO"]
    rows = [(k, i, draw.choice(pool), 90, 60 * i, 0, 10, 20, 1, 1, draw.randrange(3)) for k in range(150) for i in range(draw.randrange(1, 14))]
    table = spark.createDataFrame(rows, "k int, i int, text string, conf int, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    index = LabelIndex.of(VARIANTS)
    images = W.word_arrays(table, ["k"], index).withColumn("lines", fields.visual_lines(F.col("words")))
    images = images.withColumn("ends", F.transform("lines", lambda line: index.ended(F.transform(line, lambda w: w["hits"]))))
    images = images.withColumn("any", F.transform("ends", lambda e: F.aggregate(e, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))))
    columns = {f"{kind}_{f}": span for f in VARIANTS for kind, span in (("old", fields.find_span(F.col("lines"), VARIANTS[f])), ("new", index.span(f, F.col("lines"), F.col("ends"), F.col("any"))))}
    short = lambda s: F.concat_ws(",", s["at"].cast("string"), s["first"]["i"].cast("string"), s["last"]["i"].cast("string"))
    found = 0
    for r in images.select(*[short(s).alias(n) for n, s in columns.items()]).collect():
        for f in VARIANTS:
            assert r[f"old_{f}"] == r[f"new_{f}"]
            found += r[f"new_{f}"] != ""
    assert found > 100


def test_label_index_has_a_bit_for_each_token():
    assert R.INDEX.fields == list(R.WANTED) and dict(R.INDEX.lengths).keys() == {1, 2}
    try:
        LabelIndex.of({"a": [f"w{i}" for i in range(63)]})
    except ValueError as e:
        assert "63 tokens" in str(e)
    else:
        raise AssertionError


def test_values_that_are_too_long_end_at_a_word(spark):
    words = [("aa", 0, False), (":", 20, False), ("bbb", 40, False), ("cccc", 60, False), ("name", 80, True), ("dd", 100, False)]
    table = spark.createDataFrame([([{"text": t, "x": x, "stop": s} for t, x, s in words],)], "words array<struct<text:string,x:int,stop:boolean>>")
    value = lambda start, most: table.select(fields.join_value(F.col("words"), F.lit(start), most).alias("v")).head()["v"]
    assert value(0, 64) == "aa bbb cccc" and value(30, 64) == "bbb cccc" and value(0, 12) == "aa bbb cccc" and value(0, 11) == "aa bbb" and value(0, 2) == "" and value(90, 9) == "dd"
    assert L.LABEL_SEPARATORS
