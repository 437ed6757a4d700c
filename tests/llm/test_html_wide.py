"""Hosts whose wrapper outgrows NODES: what is beside the article in rare groups is judged by all its pages."""

import json

import pytest

from docengine.llm import html


def letters(i):
    return "".join("abcdefghij"[int(c)] for c in str(i))


def wide(n, kinds):
    """Every page has a group of its own name, and one of ``kinds`` rarer templates with readers' comments that outweigh the article's part in it."""
    out = []
    for i in range(n):
        body = [f"Paragraph {k} of page {i} with {letters(i * 7 + k)} and some words." for k in range(4)]
        said = "".join(f"<div class=c{letters(i % kinds)}><p>Reader {k} says {letters(i + k)} of some length here, and a little more.</div>" for k in range(9))
        page = (
            f"<body><div class=x{letters(i)}>Own block {letters(i)} here</div><div class=text>{''.join(f'<p>{b}' for b in body)}"
            f"<div class='r{letters(i % kinds)} comments'>{said}</div></div><div class='l{letters(i % kinds)}'><a href=/{i}>Link of page {letters(i)}</a></div></body>"
        )
        out.append((page, body))
    return out


@pytest.fixture
def table(spark):
    pages = wide(240, 60)
    return spark.createDataFrame([(i, "http://a.example/", p) for i, (p, _) in enumerate(pages)], "page_id long, url string, html string"), {i: "\n".join(w) for i, (_, w) in enumerate(pages)}


def test_html_rare_groups_are_not_forgotten(monkeypatch, table):
    rows, want = table
    texts = lambda parts: {g["page_id"]: g["text"] for g in html.main_text(rows.repartition(parts)).collect()}
    assert texts(1) == want  # a wrapper of all elements, uncut
    real, most = (html._fold_pages, html._merge), html.NODES

    def fold(batches):
        html.NODES = 150  # workers import the module anew, and keep it
        try:
            yield from real[0](batches)
        finally:
            html.NODES = most

    def merge(part):
        html.NODES = 150
        try:
            return real[1](part)
        finally:
            html.NODES = most

    monkeypatch.setattr(html, "_fold_pages", fold)
    monkeypatch.setattr(html, "_merge", merge)
    assert [r["cut"] for r in html.wrappers(rows).mapInArrow(html._plans, "host string, plan string, cut boolean").collect()] == [True]
    for parts in (1, 5):
        assert texts(parts) == want


def test_html_places_judge_as_a_wrapper(spark, table):
    rows, _ = table
    plan = html.Plan(html.Node.load(json.loads(html.wrappers(rows).collect()[0]["wrapper"])))
    pages = rows.selectExpr("html", "'a.example' AS host")
    got = {g["place"].replace(html.SEP, "/") for g in html.places(pages).where("beside").collect()}
    assert {p for p in got if not any(p.startswith(f"{q}/") for q in got)} == plan.beside
