"""The training-data operators on small and awkward tables, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from docengine.llm import bpe, exact_dedup, html, kneser_ney, langid, mixing, near_dedup, quality_rules, substring_dedup, toxicity
from docengine.llm.components import components

WS = r"[\x20\x09-\x0D]"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key long, kept boolean"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def rows():
    """Nulls everywhere, empty and blank texts, a long text, ties, repeated rows, clashing columns."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
    texts = ["", None, " \t\n", A, A + " ", " " + A, A.upper(), A + " x", A.replace("ten", "TEN zz"), long, long + " end", "short text", "short  text", "É è ñ ü ß",
             "Das ist der Hund und die Katze. " * 4, "Le chat est dans la maison avec des amis. " * 4, "The cat is in the house with the dog. " * 4, "a b c d e " * 8]
    out = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], i, 0.5, 1, True) for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, A, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(18)] + [(None, None, None)], "doc_id long, quality int, toxic int")


def key(v):
    return (v is None, v)


@pytest.mark.parametrize(("size", "bits"), [(4096, 63), (16, 63), (64, 3)])
def test_exact_dedup(docs, size, bits):
    groups = {}
    for r in rows():
        groups.setdefault(re.sub(WS, "", r[1] or ""), []).append(r)
    want = Counter()
    for norm, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1] or ""), key(r[0])))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        want.update((r[0], best[0], len(own), sha) for r in own)
    got = exact_dedup.exact_dedup(docs, size=size, bits=bits).collect()
    assert Counter((g["doc_id"], g["keep_id"], g["group_size"], g["text_sha256"]) for g in got) == want
    kept = Counter(g["text_sha256"] for g in got if g["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(g["doc_id"] == g["keep_id"] for g in got if g["kept"])


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    best = {}
    for i, r in enumerate(rows):
        best[root(i)] = min(best.get(root(i), (True, None)), key(r[0]), key=lambda k: (k[0], k[1] or 0))
    return [(r[0], len(sets[i]), best[root(i)][1] if sets[i] else r[0]) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("leaf", "weight"), [(2048, 2_000_000), (2, 40)])
def test_near_dedup(docs, monkeypatch, leaf, weight):
    monkeypatch.setattr(near_dedup, "LEAF", leaf)
    monkeypatch.setattr(near_dedup, "WEIGHT", weight)
    got = near_dedup.near_dedup(docs).collect()
    assert Counter((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == Counter(brute_components(rows()))
    kept = Counter(g["component_id"] for g in got if g["kept"] and g["n_shingles"])
    assert set(kept.values()) == {1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (41, 50), (7, 7), (60, 61)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "c1 long, c2 long")).collect()}
    assert got == {i: 0 for i in range(21)} | {40: 40, 41: 40, 50: 40, 60: 60, 61: 60}


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = Counter()
    for r in rows():
        per[r[3]] += size(r[1])
    order = sorted(per, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(per), {}, 1.5 * sum(per.values())
    while True:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > 2 * per[s]}
        if not over:
            break
        target |= {s: 2 * per[s] for s in over}
        left -= sum(2 * per[s] for s in over)
        open_ -= over
    target |= share
    for g in got:
        assert g["size"] == size(g["text"]) and g["source_size"] == per[g["source"]]
        assert g["target"] == pytest.approx(target[g["source"]]) and 0 <= g["copies"] <= 2
        assert abs(g["copies"] - g["target"] / g["source_size"]) <= 1
    again = mixing.mix(docs).collect()
    assert Counter((g["doc_id"], g["copies"]) for g in got) == Counter((g["doc_id"], g["copies"]) for g in again)
    assert mixing.emit(mixing.mix(docs)).count() == sum(g["copies"] for g in got)


def base_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark, docs):
    extra = [(100, "x y z x y z x y z\nab ## $\n\nab ## $\nab ## $", "en", "s1", 1, 0.0, 0, True), (101, "a b c d e f a b c d e g h i j k l", "en", "s1", 1, 0.0, 0, True)]
    table = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    got = quality_rules.quality_rules(table).collect()
    want = Counter()
    for r in rows() + extra:
        m = base_rules(r[1])
        want[(r[0], *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert Counter((g["doc_id"], g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) for g in got) == want
    assert not any(g["kept"] and g["base_failed"] for g in got)


def test_quality_fences_come_from_the_sketches(spark):
    """Sources with other habits get other fences for every metric, and a gap decides, not a constant."""
    import math
    import random

    draw = random.Random(5)

    def kind(source, usual, odd, width):
        rows = [(source, False, 5.0 + draw.gauss(0, width), *[draw.choice([0.0, usual * draw.uniform(0.5, 1.5)]) for _ in range(3)]) for _ in range(400)]
        return rows + [(source, False, 5.0, odd * draw.uniform(0.9, 1.1), 0.0, 0.0) for _ in range(20)] + [(source, False, 5.0, 0.0, odd, 0.0) for _ in range(20)] + [(source, False, 5.0, 0.0, 0.0, odd) for _ in range(20)]

    made = kind("plain", 0.0, 0.2, 0.2) + kind("rich", 0.01, 0.8, 0.4)
    made += [("even", False, 5.0, *[draw.random() ** 3 for _ in range(3)]) for _ in range(400)]  # spread without a gap
    made += [("few", False, 5.0, 0.0, 0.0, 0.0)] * 50 + [("plain", True, 50.0, 9.0, 9.0, 9.0)] * 300  # those that fail the base rules say nothing
    rated = spark.createDataFrame([("en", *r) for r in made], "lang string, source string, base_failed boolean, mean_word double, symbol_rate double, dup_line_rate double, repeat_rate double")
    found = {(r["level"], r["source"]): r for r in quality_rules.fences(rated).collect()}
    plain, rich, even = (found[(0, s)] for s in ("plain", "rich", "even"))
    bucket = lambda v: math.floor(math.log(1 + quality_rules.UNIT * v) / math.log(quality_rules.GAMMA))
    for rate in quality_rules.RATES:
        assert 0 < plain[f"{rate}_cut"] < bucket(0.15) and bucket(0.015) < rich[f"{rate}_cut"] < bucket(0.72) and even[f"{rate}_cut"] is None
    assert plain["mean_word_high"] - plain["mean_word_low"] < 0.8 * (rich["mean_word_high"] - rich["mean_word_low"])
    assert plain["docs"] == 460 and (1, None) in found and (2, None) in found
    # A small source is judged by its language.
    kept = quality_rules.judge(spark.createDataFrame([(i, "en", s, 100, w, n, 0, 0) for i, (s, w, n) in enumerate([("plain", 500, 0), ("plain", 500, 20), ("rich", 500, 1), ("rich", 500, 80), ("plain", 5000, 0)])] + [
        (1000 + i, "en", r[0], 100, round(100 * r[2]), round(100 * r[3]), round(10 * r[4]), round(100 * r[5])) for i, r in enumerate(made) if r[0] in ("plain", "rich") and not r[1]
    ], "doc_id int, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"), ["doc_id"])
    assert {r["doc_id"]: r["kept"] for r in kept.where("doc_id < 10").collect()} == {0: True, 1: False, 2: True, 3: False, 4: False}


def test_bpe(docs):
    ranks = bpe.read_ranks(PATH)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in rows():
        ids = known.encode_ordinary(r[1] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want[(r[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    got = bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert Counter((g["doc_id"], g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) for g in got) == want
    back = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()
    assert Counter((b["doc_id"], b["text"]) for b in back) == Counter((r[0], r[1] or "") for r in rows())


def test_bpe_machine_on_any_bytes(monkeypatch):
    import random

    monkeypatch.setattr(bpe, "STATES", 200)
    merges = bpe.Merges(bpe.read_ranks(PATH))
    machine, r, vocabulary = bpe.Transducer(merges), random.Random(3), list(merges.ranks)
    for _ in range(1500):
        data = bytes(r.randrange(256) for _ in range(r.randrange(1, 12))) if r.random() < 0.3 else b"".join(r.choice(vocabulary)[: r.randrange(1, 7)] for _ in range(r.randrange(1, 6)))
        assert machine.encode(data) == merges.encode(data)


def test_utf8_stream():
    data = "aé漢😀z".encode()
    for cut in range(len(data)):
        for cut2 in range(cut, len(data)):
            stream = bpe.Utf8()
            assert "".join([stream.feed(data[:cut]), stream.feed(data[cut:cut2]), stream.feed(data[cut2:]), stream.finish()]) == data.decode()


def test_language(spark):
    texts = {"de": "Der Hund und die Katze sind nicht im Haus, aber das ist schön für mich. ", "fr": "Le chien et le chat ne sont pas dans la maison mais c'est très bien pour moi. ", "en": "The dog and the cat are not in the house but this is good for me. "}
    made = [(i, " ".join(sorted(t.split(), key=lambda w: zlib.crc32(f"{i}{w}".encode()))) , lang) for i in range(80) for lang, t in texts.items()]
    made = [(3 * i + k, t, lang) for k, lang in enumerate(texts) for i, (_, t, own) in enumerate(x for x in made if x[2] == lang)]
    table = spark.createDataFrame(made + [(1000, None, "de"), (1001, "", "fr"), (1002, "12 34 !?", "en"), (1003, "漢字", None), (None, "the dog", "en"), (3, made[1][1], "de")], "doc_id long, text string, lang string")
    got = {g["doc_id"]: g for g in langid.language(table).collect()}
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] in texts
    test = [x for x in made if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i, _, _ in test)
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in test if i != 3) >= 0.9 * len(test)
    assert all(0 <= g["score"] <= 1 for g in got.values())


def test_toxicity(spark):
    import random

    r, plain = random.Random(2), [f"w{i}" for i in range(300)]
    made, marks = [], []
    for i in range(700):
        words = [r.choice(plain) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[r.randrange(40)] = r.choice(["gruk", "blarg", "snorfel"]) + r.choice(["", "en", "x"])
        made.append((i, " ".join(words), "en" if i % 2 else "de", 0.1))
        marks.append((i, int(bad)))
    table = spark.createDataFrame(made + [(900, None, None, None), (901, "", "en", 0.0), (None, "w1", "en", 0.0)], "doc_id long, text string, lang string, score double")
    got = {g["doc_id"]: g for g in toxicity.toxicity(table, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    test = [(i, y) for i, y in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i]["predicted"] == y for i, y in test)
    assert right >= 0.9 * len(test) and all(0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5) for g in got.values())


def test_kneser_ney(spark, monkeypatch):
    """Perplexities, thresholds and verdicts against a plain version of the same formulas."""
    import math
    import random
    from collections import defaultdict

    r = random.Random(4)
    monkeypatch.setattr(kneser_ney, "ENOUGH", 5)
    made = [(i, " ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(1, 30))), ["x", "y", None][i % 3]) for i in range(40)]
    made += [(50, "", "x"), (51, None, "x"), (52, "ЖЖ 漢字 999 zzz", "z"), made[3], (None, "ab cd", "x"), (53, "ab " * 5000, "y")]
    marks = [(i, int(i % 2 == 0 or i == 50)) for i in range(51)] + [(None, 1)]
    good = {i for i, q in marks if q and i is not None}
    n = kneser_ney.ORDER

    def tokens(t):
        return [None] * (n - 1) + [" " if c in " \t\n" else "0" if c in "0123456789" else c.lower() if c.isascii() else c for c in t or ""]

    top = Counter(tuple(w[i - n + 1 : i + 1]) for d, t, _ in made if d in good for w in [tokens(t)] for i in range(n - 1, len(w)))
    levels = [top]
    for _ in range(n - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    levels = levels[::-1]
    stats = []
    for level in levels:
        n1, n2, n3, n4 = (sum(c == k for c in level.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0
        d = [min(max(k - (k + 1) * y * b / a if a else 0.5, 0.05), k - 0.05) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))] if n1 and n2 else [0.5] * 3
        total, freed = defaultdict(int), defaultdict(float)
        for g, c in level.items():
            total[g[:-1]] += c
            freed[g[:-1]] += d[min(c, 3) - 1]
        stats.append((d, total, freed))

    def p(g):
        k = len(g)
        q = p(g[1:]) if k > 1 else 1 / (1 << kneser_ney.BITS)
        d, total, freed = stats[k - 1]
        if g[:-1] not in total:
            return q
        c = levels[k - 1][g]
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total[g[:-1]] + freed[g[:-1]] / total[g[:-1]] * q

    def plain(t):
        w = tokens(t)
        return math.exp(-sum(math.log(p(tuple(w[i - n + 1 : i + 1]))) for i in range(n - 1, len(w))) / (len(w) - n + 1)) if t else None

    want = {d: plain(t) for d, t, _ in made}
    for chunk in (None, 1):
        if chunk:
            monkeypatch.setattr(kneser_ney, "MOST_IDS", 0)
            monkeypatch.setattr(kneser_ney, "BLOCK", 500)  # many blocks
        got = kneser_ney.quality(spark.createDataFrame(made, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")).collect()
        assert Counter(g["doc_id"] for g in got) == Counter(d for d, _, _ in made)
        ranked = {lang: sorted(want[d] for d, t, of in made if d in good and t and (of == lang or lang == "all")) for lang in ("x", "y", None, "all")}
        text, lang = {d: t for d, t, _ in made}, {d: x for d, _, x in made}
        for g in got:
            if not text[g["doc_id"]]:
                assert g["perplexity"] is None and not g["kept"]
                continue
            assert g["perplexity"] == pytest.approx(want[g["doc_id"]], rel=1e-6)
            own = ranked[lang[g["doc_id"]] if lang[g["doc_id"]] != "z" else "all"]
            limit = own[math.ceil(kneser_ney.KEEP * len(own)) - 1] * kneser_ney.SLACK * (1 + kneser_ney.SHORT / len(text[g["doc_id"]]))
            assert g["threshold"] == pytest.approx(limit, rel=1e-6) and g["kept"] == (g["perplexity"] <= g["threshold"])


def test_substring_dedup(spark):
    passage = "This long passage has more than twenty words in it so that it counts as a repeat. It also has a second sentence with a good many words to follow the first."
    made = [(1, f"Own start of one here. {passage} Own end of one."), (2, f"A different start é here now. {passage} Another end of it."), (3, None), (4, ""), (5, "Short one. Short one."), (6, f"line\n{passage}\nend"), (None, passage), (2, f"A different start é here now. {passage} Another end of it.")]
    got = substring_dedup.substring_dedup(spark.createDataFrame([(i, t, 0) for i, t in made], "doc_id long, text string, removed int")).collect()
    by = {}
    for g in got:
        by.setdefault(g["doc_id"], []).append(g)
    assert by[1][0]["n_removed"] == 0 and by[3][0]["text"] is None and by[4][0]["text"] == "" and by[5][0]["n_removed"] == 0
    assert len(by[2]) == 2 and by[2][0]["text"] == by[2][1]["text"]
    source = dict(made[:6])
    for i in (2, 6):
        g = by[i][0]
        assert passage not in g["text"] and len(source[i]) - len(g["text"]) == g["removed_chars"]
        s = g["removed"][0]
        assert source[i][s["start"] : s["end"]].strip() == passage
    assert by[None][0]["text"].strip() == ""


PAGE = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul>{menu}</ul></nav><div class="ad">Buy {i}</div>
<article><h1>Title {i}</h1><p>First &amp; para {i} with
 some   words<p>Second <b>bold</b>{i} text<br>here</p>{extra}</article><div class="comments"><p>Reader {i} says a lot of words here</p></div><form><p>Sign up</p></form><footer>&copy; all</footer></body></html>"""


def test_html(spark):
    pages = []
    for i in range(12):
        menu = "".join(f'<li><a href="/{k}">m{k}</a></li>' for k in range(i % 4 + 1))
        pages.append((i, f"http://h{i % 2}.example/{i}", PAGE.format(i=i, menu=menu, extra="<ul><li>Item one</li><li>Item two</li></ul>" if i % 3 == 0 else ""), "x"))
    pages += [(50, "http://h0.example/cut", pages[0][2][:-260], "x"), (60, None, None, None), (61, "not a url", "", "x"), (None, "http://lone.example/", "<body><p>Only this &eacute;</body>", None), pages[1]]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {g["page_id"]: g for g in html.main_text(table).collect()}
    for i in range(12):
        items = ["Item one", "Item two"] if i % 3 == 0 else []
        assert got[i]["text"].split("\n") == [f"Title {i}", f"First & para {i} with some words", f"Second bold{i} text here", *items]
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[60]["text"] == "" and got[61]["text"] == "" and got[None]["text"] == "Only this é" and got[50]["text"].startswith("Title 0")


def test_wrapper_is_union_free():
    a, b = (html.wrapper(html.parse(f"<body><ul>{'<li>x</li>' * n}</ul>{'<h2>s</h2>' if n > 1 else ''}<p>t{n}</p></body>")) for n in (1, 3))
    assert html.align(a, b).expression() == "<page><body><ul>(<li>'x'</li>)+</ul>(<h2>'s'</h2>)?<p>#</p></body></page>"


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    made = [exact_dedup.exact_dedup(empty), near_dedup.near_dedup(empty), mixing.mix(empty), quality_rules.quality_rules(empty), bpe.digests(empty, PATH, public_tokenizers.PATTERN),
            langid.language(empty), toxicity.toxicity(empty, none), kneser_ney.quality(empty, none), substring_dedup.substring_dedup(empty), html.main_text(pages)]
    assert [m.count() for m in made] == [0] * len(made)


def test_awkward_rows_pass(spark, docs, labels):
    n = len(rows())
    made = [langid.language(docs), toxicity.toxicity(docs, labels), substring_dedup.substring_dedup(docs), kneser_ney.quality(docs, labels)]
    assert [m.count() for m in made] == [n] * len(made)
