"""Cases in which an operator once did less than the whole job, against brute force."""

import random
import re
from collections import Counter

import pytest
from tests_llm_brute import components

from docengine.llm import html, near_dedup, substring_dedup


def variants(n, seed):
    """Edited copies of one text whose similarities lie around 0.75: a text and copies of it with one to four words changed."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(104)]
    out = []
    for i in range(n):
        own = list(base)
        for k in r.sample(range(4, 100), r.choice((1, 2, 2, 2, 3, 4))):
            own[k] = f"v{r.randrange(10**9)}"
        out.append((i, " ".join(own)))
    return out


@pytest.mark.parametrize("n", [120, 500])  # one leaf node a tree, and large nodes
def test_near_dedup_links_variants_around_the_threshold(spark, n):
    made = variants(n, 5)
    want = components(made)
    assert len({c for c, _ in want}) > 20
    got = near_dedup.near_dedup(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert Counter((g["component_id"], g["n_shingles"], g["doc_id"]) for g in got) == Counter((c, n, i) for (c, n), (i, _) in zip(want, made))


def test_near_dedup_trees_have_roots_of_their_own():
    assert len(set(near_dedup.root_coordinates())) == near_dedup.TREES


def plain_units(text):
    """(start, end, words, digest) of the units of a text, one character at a time."""
    lines, out = re.findall(r"[^\n]*\n|[^\n]+$", text), []
    at = 0
    for line in lines:
        cut, a = [], 0
        for m in re.finditer(r"[.!?]+(?=[ \t\n\v\f\r])|[。！？]+|\n", line):
            cut.append((a, m.end()))
            a = m.end()
        if a < len(line):
            cut.append((a, len(line)))
        sized = [(x, y, sum(max(len(w.encode()) // 12, 1) for w in re.findall(r"[^ \t\n\v\f\r]+", line[x:y]))) for x, y in cut]
        units, before = [], 0
        for k, (x, y, n) in enumerate(sized):
            if n >= 4:
                units.append([x, y, n, False])
                before = 0
            elif k and sized[k - 1][2] < 4 and before // 4 == (before - sized[k - 1][2]) // 4:
                units[-1][1], units[-1][2] = y, units[-1][2] + n
                before += n
            else:
                before = n if not k or sized[k - 1][2] >= 4 else before + n
                units.append([x, y, n, True])
        norm = [" ".join(re.findall(r"[^ \t\n\v\f\r]+", line[x:y])).lower() for x, y, _, _ in units]
        for k, (x, y, n, _) in enumerate(units):
            digest = (norm[k],)
            if 0 < n < 4:
                digest = (norm[k], "next", norm[k + 1]) if k + 1 < len(units) else (norm[k], "last", norm[k - 1]) if k else digest
            out.append((at + x, at + y, n, digest))
        at += len(line)
    return out


def plain_removed(rows, run):
    seen, out = set(), {}
    for d, text in sorted(rows):
        spans, open_ = [], []

        def close():
            while open_ and open_[-1][3]:
                open_.pop()
            if open_ and sum(u[2] for u in open_) >= run:
                spans.append((open_[0][0], open_[-1][1]))
            else:  # whole lines of eight words or more
                for line in re.finditer(r"[^\n]*(?:\n|$)", text):
                    own = [u for u in open_ if line.start() <= u[0] and u[1] <= line.end() and u[1] > u[0]]
                    if own and own[0][0] == line.start() and own[-1][1] == line.end() and sum(u[2] for u in own) >= 8:
                        if spans and spans[-1][1] == line.start():
                            spans[-1] = (spans[-1][0], line.end())
                        else:
                            spans.append((line.start(), line.end()))
            open_.clear()

        for a, b, n, digest in plain_units(text):
            again = n > 0 and digest in seen
            seen.add(digest)
            if again or open_ and not n:
                open_.append((a, b, n, not n))
            else:
                close()
        close()
        out[d] = spans
    return out


@pytest.mark.parametrize("run", [20, 1])
def test_substring_dedup_against_a_plain_version(spark, run):
    """Short, long, joined and wide units, blank lines, repeats inside one text; a span holds repeats only."""
    r = random.Random(9)
    pool = [" ".join(r.choice(["ab", "cd", "éf", "gh", "ij", "漢字" * 9]) for _ in range(r.choice([1, 2, 3, 5, 9, 14]))) + r.choice([".", "!!", "?", ""]) for _ in range(40)]
    rows = []
    for d in range(120):
        lines = []
        for _ in range(r.randrange(1, 7)):
            lines.append(" ".join(r.choice(pool) if r.random() < 0.8 else f"own{d} {r.random()} words here." for _ in range(r.randrange(0, 6))))
        rows.append((d, "\n".join(lines)))
    want = plain_removed(rows, run)
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), run=run).collect()
    assert {g["doc_id"]: [(s["start"], s["end"]) for s in g["removed"]] for g in got} == want
    source = dict(rows)
    for g in got:
        t = source[g["doc_id"]]
        assert "own" not in "".join(t[s["start"] : s["end"]] for s in g["removed"])
        assert len(g["text"]) == len(t) - g["removed_chars"]


def test_substring_dedup_takes_short_lines(spark):
    """A line of nine words that many texts share goes from all but the first; a shorter phrase inside other lines stays."""
    line = "this line of nine words stands in many texts"
    rows = [(d, f"own words {d} come first here\n{line}\nthen some more of text {d}\nRead more") for d in range(50)]
    rows += [(100 + d, f"text {d}: {line}, and so on to {d}") for d in range(20)]
    got = {g["doc_id"]: g["text"] for g in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(line in got[d] for d in range(50)) == 1 and line in got[0] and all(got[100 + d] == rows[50 + d][1] for d in range(20))
    assert got[7] == "own words 7 come first here\nthen some more of text 7\nRead more"


def test_substring_dedup_keeps_what_is_no_repeat(spark):
    passage = "these are the words of a passage that many of the texts share with one another in full. It has a second sentence of quite a few words too."
    rows = [(1, passage), (2, f"{passage} UNIQUE bit! {passage}"), (3, "No! Yes! Well! Why! " + passage)]
    got = {g["doc_id"]: g["text"] for g in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == passage and "UNIQUE bit!" in got[2] and "passage" not in got[2] and got[3].strip() == "No! Yes! Well! Why!"


def one_page(page):
    own = html.Plan(html.wrapper(html.parse(page)))
    return html.extract(html.parse(page), own.main, own.beside)


def site(n, seed=1, copies=1):
    """Pages without article elements: a menu, a constant head and foot, an advert, a body of div and p, comments on some."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randrange(2, 8)))
    out = []
    for i in range(n):
        body = [" ".join(word() for _ in range(r.randrange(20, 40))) for _ in range(r.randrange(2, 5))]
        menu = "".join(f"<li><a href='/{k}'>{word()}</a></li>" for k in range(r.randrange(3, 9)))
        remarks = "".join(f"<div class=comment><p>{word()} {word()}</p></div>" for _ in range(r.randrange(0, 3)))
        page = f"<body><div class=top>The site of things</div><div><ul>{menu}</ul></div><div class=text><h2>Abstract</h2>{''.join(f'<p>{x}' for x in body)}<div class='ad-box'>{word()} now</div>{remarks}</div><div class=end>All rights</div></body>"
        out += [(page, ["Abstract", *body])] * copies
    return out


@pytest.mark.parametrize(("n", "copies"), [(4, 1), (9, 1), (30, 1)])
def test_html_wrapper_decides_what_is_beside(spark, n, copies):
    """The merged result is that of one process, at any number of pages and partitions."""
    pages = site(n, copies=copies)
    done = None
    for page, _ in pages:
        own = html.wrapper(html.parse(page))
        done = own if done is None else html.bounded(html.align(done, own))
    plan = html.Plan(done)
    for page, want in pages:
        assert html.extract(html.parse(page), plan.main, plan.beside) == want
    table = spark.createDataFrame([(i, "http://a.example/", p) for i, (p, _) in enumerate(pages)], "page_id long, url string, html string")
    for parts in (1, 5):
        got = {g["page_id"]: g["text"] for g in html.main_text(table.repartition(parts)).collect()}
        assert got == {i: "\n".join(want) for i, (_, want) in enumerate(pages)}


def test_html_copies_of_a_page_do_not_hide_it(spark):
    page = "<body><div><p>" + "same words of the page " * 5 + "</p><div>text in a div</div></div></body>"
    table = spark.createDataFrame([(i, "http://a.example/", page) for i in range(15)], "page_id long, url string, html string")
    assert {g["text"] for g in html.main_text(table).collect()} == {("same words of the page " * 5).strip() + "\ntext in a div"}


def test_html_tag_soup():
    assert one_page("<html><head><title>x</title><body><article><p>Main text") == ["Main text"]
    assert one_page("<body><p title=it's>one<p>two<p title='a>b'>three</p><p class=\"x\">four") == ["one", "two", "three", "four"]
    assert one_page("<body><article><h1>T</h1><div class='product-review-tags'><p>" + "body words " * 30 + "</div><p>next</article>")[1].startswith("body words")
    deep = "<div>" * 400 + "<p>in</p>" + "</div>" * 400 + "<p>after</p>"
    assert one_page(f"<body>{deep}</body>") == ["in", "after"]


def test_html_wrapper_is_bounded(monkeypatch):
    monkeypatch.setattr(html, "NODES", 200)
    done = None
    for i in range(300):
        name = "".join("abcdefghij"[int(c)] for c in str(i))
        own = html.wrapper(html.parse(f"<body><div class=x{name}>w{i} one</div><div class=text><p>{'word ' * 20}{i}</div></body>"))
        done = own if done is None else html.bounded(html.align(done, own))
    count = lambda n: 1 + sum(map(count, n.kids))
    assert count(done) <= 220 and html.Plan(done).main == ["body", "div.text"]


def test_html_matches_are_ascending():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([html.Node(r.choice("abc")) for _ in range(r.randrange(0, 9))] for _ in range(2))
        got = html._matches(a, b)
        assert all(a[i].name == b[j].name for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("extra", ['<svg class="i"/>', "<svg-icon></svg-icon>", "<title-bar></title-bar>", "<template-x></template-x>", '<svg><path d="a>b"/></svg>', "<template>no</template>", "<select><option>x</select>", "<svg>", "<iframe src=x>"])
def test_html_elements_without_text_end_where_they_end(extra):
    body = "".join(f"<p>Paragraph {i} of the article with some words." for i in range(4))
    assert one_page(f"<body>{extra}<article>{extra}{body}</article></body>") == [f"Paragraph {i} of the article with some words." for i in range(4)]


@pytest.mark.parametrize("n_comments", [0, 1, 2, 4, 8, 16, 60])
@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("n_pages", [1, 4])
def test_html_comments_of_any_length_are_no_article(n_comments, inside, n_pages):
    """From none to more than 90 % of the text; the plain answer is the article's own paragraphs."""
    def page(k):
        body = "".join(f"<p>Paragraph {i} of page {k} with some words." for i in range(4))
        said = "".join(f"<div class=comment><p>Reader {i} says something {i * k} of some length here.</div>" for i in range(n_comments))
        list_ = f"<section class=comments>{said}</section>"
        return f"<body><nav>menu</nav>{f'<article>{body}{list_}</article>' if inside else f'<article>{body}</article>{list_}'}<footer>end</footer></body>"

    pages = [page(k) for k in range(n_pages)]
    done = None
    for p in pages:
        own = html.wrapper(html.parse(p))
        done = own if done is None else html.align(done, own)
    plan = html.Plan(done)
    for k, p in enumerate(pages):
        assert html.extract(html.parse(p), plan.main, plan.beside) == [f"Paragraph {i} of page {k} with some words." for i in range(4)]


def test_html_an_article_keeps_its_lists_of_links():
    links = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(5))
    got = one_page(f"<body><div><ul>{links}</ul></div><article><p>Some words about the links below.</p><ul>{links}</ul></article></body>")
    assert got == ["Some words about the links below.", *[f"Link number {i}" for i in range(5)]]
