"""The pipeline against a plain version of its stages."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from docengine.llm import bpe, mixing

from tests_llm_brute import components, words


def test_run(spark, tmp_path):
    r = random.Random(6)
    plain = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        text = [r.choice(plain) for _ in range(60)]
        if i % 5 == 0:
            text[7] = "gruk"
        rows.append([i, " ".join(text), "en", [None, "a", "b"][i % 3], 0])
    rows += [[200, rows[1][1] + " ", "en", "a", 0], [201, rows[2][1].replace(" ", "  "), "en", "b", 0], [202, rows[3][1] + " tail", "en", "b", 0], [203, None, None, None, None], [204, "", "en", "a", 0], rows[4], [None, rows[6][1], "en", "a", 0]]
    folder = str(tmp_path / "sf")
    spark.createDataFrame([tuple(x) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = [tuple(x) for x in corpus_pipeline.drop_toxic(spark, docs, folder).collect()]
    assert sum("gruk" in (x[1] or "") for x in clean) <= 3 and len(clean) >= 90

    best = {}
    for x in clean:
        norm = re.sub(r"[\x20\x09-\x0D]", "", x[1] or "")
        rank = (-len(x[1] or ""), x[0] is None, x[0] or 0)
        if norm not in best or rank < best[norm][0]:
            best[norm] = (rank, x)
    single = [x for _, x in best.values()]
    comp = components([(x[0], x[1]) for x in single])
    far = [x for x, (root, n) in zip(single, comp) if not n or x[0] == root]
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(corpus_pipeline.TOKENIZER)), special_tokens={})
    rates = mixing.mix(spark.createDataFrame(far, docs.schema)).select("doc_id", "copies").collect()
    copies = {x["doc_id"]: x["copies"] for x in rates}
    want = Counter()
    for x in far:
        ids = known.encode_ordinary(x[1] or "")
        want[(x[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest())] += copies[x[0]]
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((g["doc_id"], g["n_tokens"], g["ids_sha256"]) for g in got) == +want
    total = sum(words(x[1]) for x in far)
    assert abs(sum(copies[x[0]] * words(x[1]) for x in far) - 1.5 * total) < 0.1 * total


def test_stages_keep_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "bpe"]
    docs = spark.createDataFrame([(1, "a b c", "en", None, 5), (1, "a b c", "en", None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and kept.count() == 1


CLASH = "doc_id long, text string, lang string, source string, n_chars long, rate double, copy int, size string, score string, target string, _k1 string, _k2 int, copies string, salt int, rid string, kept int, attributes map<string,int>"


def clashing():
    r = random.Random(7)
    more = (0.5, 7, "large", "high", "there", "k", 2, "c", 3, "r", 9, {"a": 1})
    rows = [(i, " ".join(r.choice(["a", "b", "c", "d"]) + str(r.randrange(90)) for _ in range(30)), "en", [None, "a", "b"][i % 3], 1, *more) for i in range(30)]
    rows += [(40, None, None, None, None, *[None] * 12), (41, "", "en", "a", 0, *[None] * 12), (None, "w " * 40000, None, "b", 0, *more), rows[3], rows[4][:2] + ("de",) + rows[4][3:]]
    return rows


def test_clashing_columns_and_awkward_rows(spark, tmp_path):
    folder = str(tmp_path / "sf")
    docs = spark.createDataFrame(clashing(), CLASH)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert {r["size"] for r in out.collect()} <= {"large", None}
    one = corpus_pipeline.drop_copies(spark, docs, folder)
    assert one.count() == 32 and corpus_pipeline.drop_near_copies(spark, docs, folder).where("doc_id = 4").first()["lang"] == one.where("doc_id = 4").first()["lang"]
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([], CLASH).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
