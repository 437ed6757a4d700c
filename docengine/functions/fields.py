"""Record fields from reconstructed lines and, failing that, from word boxes.

Line extractors take what ``normal_lines`` makes of an array of line strings, which is
made once for all of them, or the array itself.  Word extractors take the array
that operators.words.word_arrays makes: structs (text, x, y, w, h, block_num, par_num,
line_num, norm, stop) in recognition order, some dozens of words of one image.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions import labels as L
from docengine.functions import text as T
from docengine.functions.labelindex import LabelIndex, tokens


def _first(values: Column) -> Column:
    return F.coalesce(F.get(F.filter(values, lambda v: v != ""), F.lit(0)), F.lit(""))


def normal_lines(lines: Column) -> Column:
    """Lines as structs: their normal form, and that with its case folded."""
    normal = F.transform(lines, T.normalize_line)
    return F.transform(normal, lambda s: F.struct(s.alias("line"), T.folded(s).alias("folded")))


def _marked(line: Column, pattern: str, value: Column) -> Column:
    """``value`` if the line may hold the pattern, else the empty string."""
    return F.when(T.either([F.contains(line["folded"], F.lit(m)) for m in L.LINE_MARKS[pattern]]), value).otherwise("")


def name_of(lines: Column, normal: Column | None = None) -> Column:
    """The value of the first name line that names no relative."""

    def one(line: Column) -> Column:
        def test(norm: Column) -> Column:
            wanted = norm.rlike(f"(?iu){L.NAME_LINE}") & ~norm.rlike(f"(?iu)(?:{L.RELATION_WORDS})")
            return F.when(wanted, T.value_of_normal(line["line"], L.NAME_PATTERN)).otherwise("")

        return _marked(line, L.NAME_PATTERN, T.let(F.lower(line["line"]), test))

    return _first(F.transform(normal_lines(lines) if normal is None else normal, one))


def relation_of(lines: Column, normal: Column | None = None) -> Column:
    """struct<type, name> of the first line and, in it, the first kind of relative with a value."""

    def value(line: Column, pattern: str) -> Column:
        v = F.regexp_replace(T.value_of_normal(line["line"], pattern), rf"^பெயர்\s*{T.DASH}?\s*", "")
        return _marked(line, pattern, T.strip(F.regexp_replace(v, rf"(?i)^name\s*{T.DASH}?\s*", "")))

    def one(line: Column) -> Column:
        return F.array(*[F.struct(F.lit(kind).alias("type"), value(line, p).alias("name")) for kind, p in L.RELATION_PATTERNS.items()])

    found = F.get(F.filter(F.flatten(F.transform(normal_lines(lines) if normal is None else normal, one)), lambda r: r["name"] != ""), F.lit(0))
    return F.coalesce(found, F.struct(F.lit("").alias("type"), F.lit("").alias("name")))


def house_of(lines: Column, normal: Column | None = None) -> Column:
    def one(line: Column) -> Column:
        value = F.regexp_replace(T.value_of_normal(line["line"], L.HOUSE_PATTERN), rf"(?iu)(?:{L.VALUE_CUT}).*", "")

        def pick(v: Column) -> Column:
            # Digits of any script may start or continue the number.
            number = F.regexp_extract(v, r"^(\p{Nd}[\p{Nd}A-Za-z/\-]{0,15})", 1)
            rest = F.regexp_replace(v, r"[^\p{Nd}A-Za-z/\-]", "")
            return F.when(number != "", number).when(F.length(rest) <= 15, rest).otherwise("")

        return _marked(line, L.HOUSE_PATTERN, T.let(F.regexp_replace(value, rf"[{T.SPACE}]+", ""), pick))

    return _first(F.transform(normal_lines(lines) if normal is None else normal, one))


def age_of(lines: Column, normal: Column | None = None) -> Column:
    pattern = rf"(?iu)(?:{L.AGE_PATTERN})\s*{T.DASH}?\s*(\p{{Nd}}{{1,3}})"
    return _first(F.transform(normal_lines(lines) if normal is None else normal, lambda line: _marked(line, L.AGE_PATTERN, F.regexp_extract(line["line"], pattern, 1))))


def gender_of(lines: Column, strict: bool = False, normal: Column | None = None) -> Column:
    """The first run after the label, mapped in order by containment either way.

    Compatible mode finds ``male`` in ``Female``; strict mode tries longer keys first.
    """
    pattern = rf"(?iu)(?:{L.GENDER_PATTERN})\s*{T.DASH}?\s*(\S+)"
    values = sorted(L.GENDER_VALUES, key=lambda kv: -len(kv[0])) if strict else L.GENDER_VALUES

    def one(line: Column) -> Column:
        def mapped(raw: Column) -> Column:
            low = F.lower(raw)
            chain = F.when(raw == "", "")
            for key, value in values:
                chain = chain.when(F.contains(low, F.lit(key)) | F.contains(F.lit(key), low), value)
            return chain.when(F.length(raw) < 15, raw).otherwise("")

        return _marked(line, L.GENDER_PATTERN, T.let(F.regexp_extract(line["line"], pattern, 1), mapped))

    return _first(F.transform(normal_lines(lines) if normal is None else normal, one))


def _by_x(words: Column) -> Column:
    """Words from left to right; equal x keep their order."""
    keyed = F.transform(words, lambda w, i: F.struct(w["x"].alias("x"), i.alias("i"), w.alias("w")))
    return F.transform(F.array_sort(keyed), lambda k: k["w"])


def _line(word: Column) -> Column:
    return F.struct(word["block_num"].alias("b"), word["par_num"].alias("p"), word["line_num"].alias("l"))


def photo_line(words: Column) -> Column:
    """Whether the words' normal forms, run together, hold a photo marker."""
    joined = F.translate(F.array_join(F.transform(words, lambda w: w["norm"]), ""), "0", "o")
    marks = F.array(*[F.lit(T.match_py(m)) for m in L.PHOTO_MARKERS])
    return F.exists(marks, lambda m: F.contains(joined, m))


def tokenize_label(variant: str) -> list[str]:
    """Normalised tokens of a label variant, on the driver."""
    return list(tokens(variant))


def visual_lines(words: Column) -> Column:
    """Lines by first appearance, each from left to right."""
    keys = F.array_distinct(F.transform(words, _line))
    return F.transform(keys, lambda key: _by_x(F.filter(words, lambda w: _line(w) == key)))


def find_span(rows: Column, variants: list[str]) -> Column:
    """struct<at, first, last>: line index and words of the first label hit by line, then variant, then position; null if none.

    ``rows`` is what visual_lines gives.  A word fits a token if either contains the other.
    """
    tokens = list(dict.fromkeys(tuple(t) for t in map(tokenize_label, variants) if t))
    wanted = F.array(*[F.array(*[F.lit(t) for t in v]) for v in tokens])

    def in_line(line: Column, at: Column) -> Column:
        def of(v: Column) -> Column:
            n = F.size(v)

            def fits(i: Column) -> Column:
                pairs = F.zip_with(F.slice(line, i, n), v, lambda w, t: (w["norm"] != "") & (F.contains(w["norm"], t) | F.contains(t, w["norm"])))
                return F.forall(pairs, lambda ok: ok)

            spots = F.when(F.size(line) >= n, F.sequence(F.lit(1), F.size(line) - n + 1)).otherwise(F.array().cast("array<int>"))
            span = lambda i: F.struct(at.alias("at"), F.get(line, i - 1).alias("first"), F.get(line, i + n - 2).alias("last"))
            return F.transform(F.filter(spots, fits), span)

        return F.flatten(F.transform(wanted, of))

    return F.get(F.flatten(F.transform(rows, in_line)), F.lit(0))


def join_value(words: Column, start: Column, most: int = 64) -> Column:
    """Texts from ``start`` on until another label begins or the value would grow too long.

    Words up to the next label that fit as a whole, the usual case, are joined at once; only a
    value that is too long is folded word by word.
    """

    def step(state: Column, w: Column) -> Column:
        size = state["n"] + F.length(w["text"]) + 1
        grown = F.struct(F.concat(state["parts"], F.array(w["text"])).alias("parts"), size.alias("n"), F.lit(False).alias("done"))
        ended = F.struct(state["parts"].alias("parts"), state["n"].alias("n"), F.lit(True).alias("done"))
        return F.when(state["done"], state).when(size > most, ended).otherwise(grown)

    empty = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def before_label(kept: Column) -> Column:
        stop = F.array_position(F.transform(kept, lambda w: w["stop"]), F.lit(True)).cast("int")
        return F.when(stop > 0, F.slice(kept, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(kept)

    def joined(own: Column) -> Column:
        texts = F.transform(own, lambda w: w["text"])
        whole = T.let(F.array_join(texts, " "), lambda t: F.when(F.length(t) + 1 <= most, t))
        return F.coalesce(whole, F.aggregate(own, empty, step, lambda s: F.array_join(s["parts"], " ")))

    kept = F.filter(words, lambda w: (w["x"] >= start) & (w["text"] != "") & ~w["text"].isin(L.LABEL_SEPARATORS))
    return T.strip(T.let(T.let(kept, before_label), joined))


def next_visual_line(words: Column, label: Column, reach: int = 60) -> Column:
    """Words of the nearest line at most ``reach`` below a label, within 10 of its topmost word, by x."""
    cut = label["y"] + F.floor(label["h"] * F.lit(0.6)).cast("int")
    below = F.filter(words, lambda w: (w["y"] > cut) & (w["y"] <= cut + reach))

    def nearest(b: Column) -> Column:
        top = F.array_min(F.transform(b, lambda w: w["y"]))
        return _by_x(F.filter(b, lambda w: F.abs(w["y"] - top) <= 10))

    return T.let(below, nearest)


def following_line(words: Column, label: Column) -> Column:
    """Words of the line numbered next in the label's block and paragraph, by x (an older layout rule)."""
    return _by_x(F.filter(words, lambda w: (w["block_num"] == label["block_num"]) & (w["par_num"] == label["par_num"]) & (w["line_num"] == label["line_num"] + 1)))


def find_token(words: Column, variants: list[str]) -> Column:
    """The first word that contains a whole label variant or is contained in one; null if none (an older layout rule)."""
    wanted = F.array(*[F.lit(t) for t in dict.fromkeys(T.normalize_py(v) for v in variants) if t])
    return F.get(F.filter(words, lambda w: (w["norm"] != "") & F.exists(wanted, lambda t: F.contains(w["norm"], t) | F.contains(t, w["norm"]))), F.lit(0))


def with_label_values(
    images: DataFrame, wanted: dict[str, tuple[list[str], int]], next_line: bool = True, margin: int = -5, below: Callable[[Column, Column], Column] | None = None, index: LabelIndex | None = None
) -> DataFrame:
    """``images`` with a column for each wanted (label variants, longest value): what follows the label.

    The value stands on the label's line or, if nothing does, on the next visual line; photo
    lines give nothing.  ``margin`` moves the start of a value from the label's right edge and
    ``below`` chooses the line to go on with; older layouts use 5 or 10 and following_line.
    Lines, spans and values are built column by column, so that each is planned and evaluated once.
    With an ``index`` of the same fields, whose ``hits`` the words carry, the labels of all
    fields are found in one pass.
    """
    below = below or next_visual_line
    rows = images.withColumn("_lines", visual_lines(F.col("words")))
    if index is not None:
        rows = rows.withColumn("_ends", F.transform("_lines", lambda line: index.ended(F.transform(line, lambda w: w["hits"]))))
        rows = rows.withColumn("_any", F.transform("_ends", lambda e: F.aggregate(e, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))))
        rows = rows.withColumns({f"_span_{c}": index.span(c, F.col("_lines"), F.col("_ends"), F.col("_any")) for c in wanted})
    else:
        rows = rows.withColumns({f"_span_{c}": find_span(F.col("_lines"), variants) for c, (variants, _) in wanted.items()})
    # Photo lines give nothing; each line is judged once for all fields.
    rows = rows.withColumn("_told", F.transform("_lines", lambda line: F.when(~photo_line(line), line)))
    rows = rows.withColumns({f"_own_{c}": F.get("_told", F.col(f"_span_{c}.at")) for c in wanted})
    start = lambda c: F.greatest(F.lit(0), F.col(f"_span_{c}.last.x") + F.col(f"_span_{c}.last.w") + margin)
    rows = rows.withColumns({f"_same_{c}": join_value(F.col(f"_own_{c}"), start(c), most) for c, (_, most) in wanted.items()})
    if next_line:
        rows = rows.withColumns({f"_next_{c}": F.when(F.col(f"_same_{c}") == "", below(F.col("words"), F.col(f"_span_{c}.first"))) for c in wanted})
        rows = rows.withColumns({
            f"_same_{c}": F.when(F.col(f"_same_{c}") != "", F.col(f"_same_{c}")).when(~photo_line(F.col(f"_next_{c}")), join_value(F.col(f"_next_{c}"), F.lit(0), most))
            for c, (_, most) in wanted.items()
        })
    kept = [c for c in images.columns if c not in wanted]
    return rows.select(*kept, *[F.coalesce(f"_same_{c}", F.lit("")).alias(c) for c in wanted])


def either(first: Column, second: Column) -> Column:
    """``first``, or ``second`` where it is empty."""
    return F.when(F.coalesce(first, F.lit("")) != "", first).otherwise(F.coalesce(second, F.lit("")))
