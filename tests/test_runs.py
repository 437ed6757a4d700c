"""Pruned scans, page ranges, ordered sinks, incremental refresh, names over existing output, level statistics."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docengine.functions import labels as L
from docengine.operators import crops as C
from docengine.plans import outputs as O, records as R, refresh, stages
from docengine.sources import files, ordered, providers, scan
from docengine.sources.config import Settings

CARD = "Name : {}\nFather Name : Kumar\nHouse No : 12\nAge : 45 Gender : Male"


def opened(frame) -> int:
    """Files that the frame's scans read, by their own metric, once it has run."""
    frame.collect()
    plan, total = frame._jdf.queryExecution().executedPlan(), 0
    nodes = [plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan]
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numFiles") and "content" in node.verboseStringWithOperatorId():
            total += node.metrics().apply("numFiles").value()
        for one in (node.plan() if node.nodeName().endswith("QueryStage") else None,):
            if one is not None:
                nodes.append(one)
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def cards(root: Path, folders=("a", "b", "c"), n_pages=4, n_images=3) -> None:
    for f in folders:
        for p in range(1, n_pages + 1):
            at = root / f / "crops" / f"page-{p:03d}"
            at.mkdir(parents=True)
            for i in range(1, n_images + 1):
                (at / f"page-{p:03d}-{i:03d}.png").write_text(CARD.format(f"{f}{p}{i}"))


def test_only_chosen_files_are_opened(spark, tmp_path):
    cards(tmp_path)
    (tmp_path / "a" / "crops" / "page-001" / "odd [1]{x}+%41 *.png").write_text("x")
    listed = files.crop_images(scan.listing(spark, str(tmp_path)))
    assert listed.count() == 37 and opened(listed) == 0
    settings = Settings(limit=2, limit_pages=2)
    done = spark.createDataFrame([("a", "page-002")], "file string, page string")
    chosen = scan.choose(listed, settings, done)
    assert {(r["file"], r["page"]) for r in chosen.collect()} == {("a", "page-001"), ("b", "page-001"), ("b", "page-002")}
    got = list(scan.waves(spark, chosen, 4))
    assert [w.count() for w in got] == [4, 4, 2] and sum(opened(w) for w in got) == 10
    read = {r["path"]: bytes(r["content"]) for w in got for r in w.collect()}
    assert len(read) == 10 and any(p.endswith("odd [1]{x}+%41 *.png") and c == b"x" for p, c in read.items())
    assert scan.choose(listed, Settings(force=True), done).count() == 37


def test_waves_keep_pages_together(spark, tmp_path):
    cards(tmp_path, folders=("a", "b"))
    chosen = files.crop_images(scan.listing(spark, str(tmp_path)))
    sizes = []
    seen = set()
    for wave in scan.waves(spark, chosen, 4, keep_together=["file", "page"]):
        pages = {(r["file"], r["page"]) for r in wave.collect()}
        assert not pages & seen
        seen |= pages
        sizes.append(wave.count())
    assert len(seen) == 8 and sum(sizes) == 24 and max(sizes) <= 6
    assert list(scan.waves(spark, chosen.limit(0))) == []


def test_conditions_on_the_path_reach_the_scan(spark, tmp_path):
    cards(tmp_path)
    own = scan.pruned(spark, str(tmp_path), (F.col("file") == "b") & F.lower("ext").isin(L.CROP_EXTENSIONS) & (F.col("page") < "page-003"))
    assert own.count() == 6 and opened(own) == 6


def test_limit_opens_only_its_documents(spark, tmp_path):
    for name in ("a", "b", "c", "d"):
        (tmp_path / f"{name}.pdf").write_bytes(f"Title: {name}\fsecond".encode())
    few = stages.documents(spark, str(tmp_path), Settings(limit=2))
    assert opened(few) == 2 and sorted(r["file"] for r in few.collect()) == ["a", "b"]
    made = {r["path"]: json.loads(bytes(r["payload"])) for r in stages.extracted(spark, str(tmp_path), providers.StubPdf(), Settings()).collect() if r["path"].endswith("manifest.json")}
    assert made["a.pdf/manifest.json"]["metadata"] == {"title": "a"} and made["a.pdf/manifest.json"]["pages"] == 2


def test_a_large_document_is_many_tasks(spark, tmp_path):
    (tmp_path / "big.pdf").write_bytes(b"\f".join(b"page %d" % i for i in range(1, 5001)))
    (tmp_path / "small.pdf").write_bytes(b"only")
    settings = Settings(range_pages=64)
    ranges = providers.in_ranges(stages.documents(spark, str(tmp_path), settings), providers.StubPdf(), settings.range_pages)
    told = ranges.select("file", "pages", "first", "last", F.spark_partition_id().alias("task")).collect()
    big = [r for r in told if r["file"] == "big"]
    assert len(big) == 79 and len({r["task"] for r in big}) > 1 and max(r["last"] for r in big) == 5000
    pages = stages.extract(spark, str(tmp_path), providers.StubPdf(), settings).collect()
    whole = stages.extract(spark, str(tmp_path), providers.StubPdf(), Settings(range_pages=10_000)).collect()
    key = lambda r: (r["file"], r["page"], r["text"], bytes(r["png"]), r["name"])
    assert sorted(map(key, pages)) == sorted(map(key, whole)) and len(pages) == 5001


def tree(root: Path) -> dict[str, bytes]:
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def test_pieces_become_whole_files(spark, tmp_path):
    rows = [(f"d{f}/out.txt", i, f"{f}:{i}\n") for f in range(20) for i in range(50)]
    frame = spark.createDataFrame(rows, "path string, i int, piece string").repartition(7)
    ordered.write(frame, str(tmp_path / "whole"), ["i"], parts=3)
    assert tree(tmp_path / "whole") == {f"d{f}/out.txt": "".join(f"{f}:{i}\n" for i in range(50)).encode() for f in range(20)}
    ordered.write(frame, str(tmp_path / "parts"), ["i"], parts=3, split_bytes=10)
    tmp_path = tmp_path / "parts"
    made = tree(tmp_path)
    assert not any("_temporary" in p for p in made)
    for f in range(20):
        want = "".join(p for path, _, p in rows if path == f"d{f}/out.txt").encode()
        if f"d{f}/out.txt" in made:
            assert made[f"d{f}/out.txt"] == want
        else:
            parts = json.loads(made[f"d{f}/out.txt.parts.json"])
            assert b"".join(made[f"d{f}/{p['part']}"] for p in parts) == want and sum(p["pieces"] for p in parts) == 50
    assert sum(p.endswith("out.txt") for p in made) >= 18


def test_one_file_over_many_tasks_and_again(spark, tmp_path):
    rows = [("big.md", i, f"{i:05d} ") for i in range(4000)]
    frame = spark.createDataFrame(rows, "path string, i int, piece string")
    ordered.write(frame, tmp_path.as_uri(), ["i"], parts=4, split_bytes=1000)
    parts = json.loads((tmp_path / "big.md.parts.json").read_text())
    assert len(parts) == 4 and parts[0]["part"] == "big.00001.md" and json.loads(parts[0]["first"]) == {"i": 0}
    assert "".join((tmp_path / p["part"]).read_text() for p in parts) == "".join(p for _, _, p in rows)
    ordered.write(frame.where("i < 5"), tmp_path.as_uri(), ["i"], parts=1)
    assert sorted(tree(tmp_path)) == ["big.md"] and (tmp_path / "big.md").read_text() == "".join(p for _, _, p in rows[:5])


def test_a_failed_task_leaves_no_half_file(spark, tmp_path):
    rows = [(f"f{f:02d}", i, "x" * 100) for f in range(8) for i in range(100)]
    frame = spark.createDataFrame(rows, "path string, i int, piece string")
    with pytest.raises(Exception, match="the store is full"):
        ordered.write(frame, str(tmp_path), ["i"], parts=1, fail_after=350)
    made = tree(tmp_path)
    assert all(len(data) == 10_000 for data in made.values()) and not any("_temporary" in p for p in made)


def test_named_outputs(spark, tmp_path):
    rows = [("f1", f"p{p}", f"i{i}.png", str(i), "ABC123", True, f"N{i}", "father", "F", "1", "30", "Male") for p in range(3) for i in range(2)] + [("f2", "p0", "x.png", "1", "", False, "", "", "", "", "", "")]
    kinds = ", ".join(f"{c} {'boolean' if c == 'epic_valid' else 'string'}" for c in ["file", "page", "image", *R.FIELDS])
    records = spark.createDataFrame(rows, kinds)
    settings = Settings()
    words = spark.createDataFrame([("f1", "p0", "i0.png", 0, "hi", 90, 0, 0, 5, 5, 1, 1, 1, 1)], "file string, page string, image string, i int, text string, conf int, x int, y int, w int, h int, block_num int, par_num int, line_num int, word_num int")
    stages.read_outputs(records, settings, 7, str(tmp_path), words, "--psm 6")
    made = tree(tmp_path)
    assert {p for p in made if p.startswith("f2")} == {"f2/output/f2.json", "f2/output/f2.md", "f2/output/page_wise/p0.json", "f2/output/page_wise/p0.md"}
    assert "f1/output/raw_ocr.md" in made and "f1/output/raw_ocr/p0/i0.md" in made
    pages = O.page_payloads(records, settings.languages, True, 7)
    for f in O.file_payloads(pages).collect():
        assert json.loads(made[f"{f['folder']}/output/{f['folder']}.json"]) == json.loads(O.file_payloads(pages).where(F.col("folder") == f["folder"]).select(F.to_json(F.struct("*"))).head()[0])
    for f in O.file_markdown(O.file_payloads(pages)).collect():
        assert made[f"{f['folder']}/output/{f['folder']}.md"].decode() == f["markdown"]
    assert json.loads(made["f1/output/page_wise/p1.json"])["images_count"] == 2
    dumps = O.raw_text_markdown(words, ["file", "page", "image"], settings.languages, "--psm 6")
    assert made["f1/output/raw_ocr.md"].decode() == O.raw_text_file(dumps, settings.languages, "--psm 6").head()["markdown"]
    pieces = stages.output_pieces(records, settings, 7)
    for r in O.piece_index(pieces).join(pieces, ["path", *O.PIECE_ORDER]).collect():
        assert made[r["path"]][r["start"] : r["start"] + r["bytes"]].decode() == (r["piece"] or "")


def test_refresh_reads_changed_pages_only(spark, tmp_path):
    crops, out = tmp_path / "crops", str(tmp_path / "out")
    cards(crops, folders=("a", "b"), n_pages=3, n_images=2)
    (crops / "a" / "crops" / "loose.png").write_text("no page")
    run = lambda n, **more: refresh.refresh(spark, str(crops), out, providers.StubOcr(), Settings(**more), n, most=3)
    first = run(1)
    assert (first.read, first.removed) == (6, 0) and first.waves > 1
    assert {(r["file"], r["page"], r["name"]) for r in refresh.read_records(spark, out).collect()} == {(f, f"page-{p:03d}", f"{f}{p}{i}") for f in "ab" for p in (1, 2, 3) for i in (1, 2)}
    times = lambda: {str(p): p.stat().st_mtime_ns for p in Path(out, "records").rglob("*.parquet")}
    before = times()
    assert run(2) == refresh.Refreshed() and times() == before

    (crops / "a" / "crops" / "page-002" / "page-002-001.png").write_text(CARD.format("changed"))
    os.remove(crops / "b" / "crops" / "page-003" / "page-003-001.png")
    for f in (crops / "b" / "crops" / "page-001").iterdir():
        f.unlink()
    third = run(3)
    assert (third.read, third.removed) == (2, 1)
    now = {(r["file"], r["page"], r["name"]) for r in refresh.read_records(spark, out).collect()}
    assert ("a", "page-002", "changed") in now and ("b", "page-003", "b32") in now and not any(f == "b" and p in ("page-001",) for f, p, _ in now) and len(now) == 9
    kept = {p: t for p, t in times().items() if p in before}
    assert len(kept) == 3 and all(before[p] == t for p, t in kept.items())
    assert run(4) == refresh.Refreshed()
    assert run(5, force=True).read == 5


def names_by_fold(crops, snapshot):
    """Crop by crop, as files would be written."""
    disk, out = set(snapshot), {}
    for file, page_id, base, pos, i in sorted(crops, key=lambda c: (c[0], c[3], c[4])):
        name = f"{page_id}-{i:03d}.png"
        extra = base[len(page_id) :].lstrip("-_")
        if (file, page_id, name) in disk and base != page_id and extra:
            name = f"{page_id}-{extra}-{i:03d}.png"
        disk.add((file, page_id, name))
        out[(file, page_id, name)] = (pos, i)
    return out, disk


def test_crop_names_over_existing_output(spark):
    bases = ["page-001", "page-001-img-01", "page-001-img-02", "page-002_IMG_3", "page-002-img-4"]
    crops = [("f", b[:8], b, pos, i) for pos, b in enumerate(bases) for i in (1, 2, 1000)]
    frame = spark.createDataFrame(crops, "file string, page_id string, page_base string, path_pos int, i int")
    disk = set()
    for _ in range(3):
        want, after = names_by_fold(crops, disk)
        snapshot = spark.createDataFrame([*disk, ("g", "page-001", "page-001-001.png")], "file string, page_id string, crop_name string")
        got = {(r["file"], r["page_id"], r["crop_name"]): (r["path_pos"], r["i"]) for r in C.crop_names(frame, snapshot).collect()}
        assert got == want
        disk = after
    assert {tuple(r) for r in C.crop_names(frame).select("crop_name").collect()} == {(k[2],) for k in names_by_fold(crops, set())[0]}


def test_levels_and_observed_counts(spark, tmp_path):
    rows = [("a", "p1", 1.0, None), ("a", "p1", 2.0, "bad"), ("a", "p2", 4.0, None), ("b", None, 0.5, "bad")]
    frame = spark.createDataFrame(rows, "file string, page string, seconds double, error string")
    got = {(r["level"], r["file"], r["page"]): tuple(r)[3:] for r in R.levels(frame).collect()}
    assert got[("run", None, None)] == (4, 2, 2, 7.5, 1.875, 3750.0)
    assert got[("file", "a", None)] == (3, 2, 1, 7.0, 2.3333, 3500.0) and got[("page", "b", None)] == got[("file", "b", None)] == (1, 0, 1, 0.5, 0.5, 0.0)
    assert got[("page", "a", "p1")] == (2, 1, 1, 3.0, 1.5, 3000.0) and len(got) == 6
    out, seen = R.watched(frame)
    out.write.parquet(str(tmp_path / "w"))
    assert seen.get == {"images": 4, "ok": 2, "failed": 2}
    assert [(r["level"], r["images"]) for r in R.levels(frame.limit(0)).collect()] in ([], [("run", None)])
