"""Fields of metadata documents are looked up in their objects, and those once in the document."""

import json
import re

from docengine.functions import metadata as M


def test_objects_are_looked_up_once(spark):
    docs = [
        {"detailed_elector_summary": {"net_total": {"total": "1,200"}, "serial_number_range": [1, 2]}, "elector_summary": {"total_electors": 7, "serial_number_start": 3}},
        {"detailed_elector_summary": None, "elector_summary": {"total_electors": 7}}, {"detailed_elector_summary": [1], "authority": "x"}, {"detailed_elector_summary": {"net_total": None}}, [1], 5,
    ]
    rows = M.typed(spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, document string"))
    got = {r["k"]: (r["s"]["net_total"]["total"], r["s"]["serial_number_range"]["start"], r["n"], r["parsed"]) for r in rows.selectExpr("k", "detailed_elector_summary AS s", "size(misfit) AS n", "parsed").collect()}
    assert got == {0: (1200, 3, 0, True), 1: (7, None, 0, True), 2: (None, None, 0, True), 3: (None, None, 0, True), 4: (None, None, 0, True), 5: (None, None, 0, True)}
    plan = rows._jdf.queryExecution().analyzed().toString()
    tops = {p.split(".")[0] for p in [*M.leaves(), *M.OLDER.values()]}
    assert 0 < len(re.findall(r"try_variant_get\(_doc", plan)) <= len(tops)
