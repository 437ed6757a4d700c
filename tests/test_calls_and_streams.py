"""The ledger of model calls, running sums, typed metadata, and pages that are complete in a stream."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docengine.functions import metadata
from docengine.plans import calls
from docengine.sources import providers
from docengine.streaming import pages

PRICING = {"currency": "USD", "input_cost_per_1m_tokens": 1_000_000.0, "output_cost_per_1m_tokens": 0.0}


def counting(notes):
    """A stub that notes each call in a folder, and fails for images that say so, the first time or always."""

    class Counting(providers.StubVision):  # local, so that it travels by value
        def ask(self, prompt, images):
            import os
            import uuid

            before = len([n for n in os.listdir(folder) if n.startswith(images[0])])
            open(f"{folder}/{images[0]}-{uuid.uuid4().hex}", "w").close()
            if images[0] == "never" or (images[0] == "once" and before == 0):
                raise RuntimeError("busy")
            return '{"of": "%s"}' % images[0], {"prompt_tokens": 2, "completion_tokens": 1, "total_tokens": 3}

    folder = str(notes)
    return Counting()


def questions(spark, names, model="m"):
    rows = spark.createDataFrame([(n, n, "b") for n in names], "file string, front_url string, back_url string")
    return rows.withColumn("question", calls.question(model, "p", F.col("front_url"), F.col("back_url")))


def test_nothing_is_asked_twice(spark, tmp_path):
    notes, book = tmp_path / "notes", str(tmp_path / "ledger")
    notes.mkdir()
    asked = questions(spark, ["a", "b", "once", "never", "a"])
    one = calls.ask(spark, asked, counting(notes), "p", PRICING, book, attempts=3)
    made = sorted(p.name.rsplit("-", 1)[0] for p in notes.iterdir())
    assert made == ["a", "b", "never", "never", "never", "once", "once"] and (one.rounds, one.calls, one.failed) == (3, 7, 4)
    assert calls.ask(spark, asked, counting(notes), "p", PRICING, book, attempts=3) == calls.Asked()
    assert len(list(notes.iterdir())) == 7
    known = {r["question"]: r for r in calls.state(calls.read_ledger(spark, book)).collect()}
    by_name = {r["front_url"]: known[r["question"]] for r in asked.collect()}
    assert by_name["once"]["attempts"] == 2 and json.loads(by_name["once"]["answer"]) == {"of": "once"}
    assert not by_name["never"]["answered"] and by_name["never"]["error"] == "RuntimeError: busy"
    # Another model or another image is another question; a renamed folder is the same.
    assert calls.ask(spark, questions(spark, ["a"], "other"), counting(notes), "p", PRICING, book).calls == 1
    assert calls.ask(spark, asked.withColumn("file", F.lit("moved")), counting(notes), "p", PRICING, book).calls == 0


def test_budget_ends_a_run(spark, tmp_path):
    notes, book = tmp_path / "notes", str(tmp_path / "ledger")
    notes.mkdir()
    asked = questions(spark, [f"q{i}" for i in range(10)])
    got = calls.ask(spark, asked, counting(notes), "p", PRICING, book, budget=9.0, first_estimate=2.0)
    assert got.calls == 4 and got.broke and got.spent == 8.0
    assert calls.ask(spark, asked, counting(notes), "p", PRICING, book, budget=9.0, first_estimate=2.0).calls == 0
    assert calls.ask(spark, asked, counting(notes), "p", PRICING, book, budget=100.0).calls == 6
    assert sorted(p.name.rsplit("-", 1)[0] for p in notes.iterdir()) == [f"q{i}" for i in range(10)]


def test_running_sums_need_no_single_window(spark):
    rows = spark.createDataFrame([(i * 37 % 101, float(i % 7)) for i in range(101)], "k int, v double").repartition(5)
    got = {r["k"]: r["running"] for r in calls.running(rows, ["k"], "v").collect()}
    total, want = 0.0, {}
    for k, v in sorted((r["k"], r["v"]) for r in rows.collect()):
        total += v
        want[k] = total
    assert got == want and calls.running(rows.limit(0), ["k"], "v").count() == 0


@pytest.mark.parametrize(("document", "field", "value", "misfit"), [
    ('{"document_metadata":{"electoral_roll_year":"2,025"}}', "document_metadata.electoral_roll_year", 2025, []),
    ('{"document_metadata":{"electoral_roll_year":2025.0}}', "document_metadata.electoral_roll_year", 2025, []),
    ('{"document_metadata":{"electoral_roll_year":"soon"}}', "document_metadata.electoral_roll_year", None, [("document_metadata.electoral_roll_year", '"soon"')]),
    ('{"document_metadata":{"electoral_roll_year":null}}', "document_metadata.electoral_roll_year", None, []),
    ('{"document_metadata":{"language_detected":"Tamil"}}', "document_metadata.language_detected", ["Tamil"], []),
    ('{"document_metadata":{"language_detected":["English","Tamil"]}}', "document_metadata.language_detected", ["English", "Tamil"], []),
    ('{"document_metadata":{"publicationation_date":"1-1-2025"}}', "document_metadata.publication_date", "1-1-2025", []),
    ('{"elector_summary":{"male_electors":"1,205"}}', "detailed_elector_summary.net_total.male", 1205, []),
    ('{"detailed_elector_summary":{"net_total":{"male":7}},"elector_summary":{"male_electors":8}}', "detailed_elector_summary.net_total.male", 7, []),
    ('{"part_details":{"sections":[{"section_number":1,"section_name":"x","more":2}]}}', "part_and_polling_details.sections", [("1", "x")], []),
    ('{"authority":{"signature_present":"Yes"}}', "authority_verification.signature_present", True, []),
    ('{"authority_verification":{"signature_present":{"a":1}}}', "authority_verification.signature_present", None, [("authority_verification.signature_present", '{"a":1}')]),
    ('[1, 2]', "document_metadata.state", None, []),
])
def test_typed_metadata(spark, document, field, value, misfit):
    row = metadata.typed(spark.createDataFrame([(document,)], "document string")).head()
    got = row
    for part in field.split("."):
        got = got[part]
    assert ([tuple(x) if not isinstance(x, str) else x for x in got] if isinstance(got, list) else got) == value
    assert row["parsed"] and [tuple(m) for m in row["misfit"]] == misfit


def test_documents_that_are_no_json(spark):
    rows = spark.createDataFrame([("no",), (None,), ('{"a":1}',), ('{"a":"x","b":[1]}',)], "document string")
    typed = metadata.typed(rows).collect()
    assert [r["parsed"] for r in typed] == [False, False, True, True] and all(r["document_metadata"]["state"] is None for r in typed)
    shape = metadata.common_shape(rows).head()
    assert shape["unparsed"] == 2 and "a: VARIANT" in shape["shape"] and "b: ARRAY" in shape["shape"]


NOON = datetime(2025, 1, 1, 12, tzinfo=timezone.utc)


def test_pages_are_told_when_quiet(spark, tmp_path):
    """Twice-sent, late and changed crops, with a restart between all batches."""
    source, out, check = (str(tmp_path / n) for n in ("source", "out", "check"))
    schema = "file string, page string, image string, length long, changed timestamp, at timestamp"

    def arrive(*crops):
        rows = [("f", page, image, length, NOON, NOON + timedelta(seconds=at)) for page, image, length, at in crops]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        pages.complete(stream, 30, "5 seconds").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["page"], r["version"], r["images"].split("\n")) for r in spark.read.schema(pages.COMPLETE).parquet(out).collect())

    assert arrive(("p1", "a.png", 1, 0), ("p1", "b.png", 1, 2), ("p2", "x.png", 1, 3)) == []
    # p1's crop comes again unchanged, which does not keep it open; p2 gets a late one.
    assert arrive(("p1", "a.png", 1, 25), ("p2", "late.png", 1, 1), ("p3", "z.png", 1, 20)) == []
    told = arrive(("p4", "q.png", 1, 45))
    assert told == [("p1", 1, ["a.png", "b.png"]), ("p2", 1, ["late.png", "x.png"])]
    # A changed crop opens p1 again.
    assert arrive(("p1", "a.png", 2, 50), ("p1", "c.png", 1, 50)) == told
    told = arrive(("p5", "q.png", 1, 200))
    assert ("p1", 2, ["a.png", "b.png", "c.png"]) in told and [t[:2] for t in told] == [("p1", 1), ("p1", 2), ("p2", 1), ("p3", 1), ("p4", 1)]


def test_arrivals_open_no_file(spark, tmp_path):
    at = tmp_path / "in" / "f" / "crops" / "page-001"
    at.mkdir(parents=True)
    (at / "page-001-001.png").write_text("x")
    (at / "notes.txt").write_text("x")
    stream = pages.arrivals(spark, str(tmp_path / "in"))
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert [(r["file"], r["page"], r["image"], r["length"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("f", "page-001", "page-001-001.png", 1)]
