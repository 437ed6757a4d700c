"""Scalar text functions as native Columns.

Regular expressions are written for Java and RE2 alike.  White space is what Unicode calls
so, which is more than either engine's ``\\s``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions import labels as L

SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ZERO_WIDTH = r"[\x{200c}\x{200d}\x{feff}]"
TAMIL = r"\x{0b80}-\x{0bff}"
DASH = r"[:\-–—]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a costly expression once inside one native expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def either(options: list[Column]) -> Column:
    out = options[0]
    for option in options[1:]:
        out = out | option
    return out


def strip(s: Column) -> Column:
    return F.regexp_replace(s, f"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse(s: Column) -> Column:
    return F.regexp_replace(s, f"[{SPACE}]+", " ")


def normalize_text(s: Column) -> Column:
    """Lower case, without everything but word characters and the Tamil block, so without white space and zero-width characters."""
    return F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), rf"[^\p{{L}}\p{{N}}_{TAMIL}]+", "")


def norm_for_match(s: Column) -> Column:
    return F.translate(normalize_text(s), "0", "o")


def normalize_py(s: str) -> str:
    """normalize_text of a fixed label, on the driver."""
    import re

    s = re.sub("[‌‍﻿]", "", s.strip().lower())
    return re.sub(r"[^\w஀-௿]+", "", s)


def match_py(s: str) -> str:
    return normalize_py(s).replace("0", "o")


def normalize_line(s: Column) -> Column:
    """Stripped first, then without zero-width characters, then with single spaces."""
    return collapse(F.regexp_replace(strip(s), ZERO_WIDTH, ""))


def clean_epic(raw: Column) -> Column:
    kept = F.upper(F.regexp_replace(raw, "[^A-Za-z0-9]", ""))
    fixed = F.concat(F.translate(F.substring(kept, 1, 3), "01258", "OIZSB"), F.translate(F.substring(kept, 4, 1 << 30), "OIZSB", "01258"))
    return F.when(F.length(kept) >= 3, fixed).otherwise(kept)


def epic_valid(epic: Column) -> Column:
    return F.coalesce(epic.rlike("^[A-Z]{3}[0-9]+$") & ~epic.endswith("\n"), F.lit(False))


def clean_serial(raw: Column) -> Column:
    """Digits, the last four of more, without leading zeros unless there is nothing else."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    last = F.when(F.length(digits) > 4, F.substring(digits, -4, 4)).otherwise(digits)
    bare = F.regexp_replace(last, "^0+", "")
    return F.when(bare == "", last).otherwise(bare)


def fold_serial(readings: Column) -> Column:
    """The serial number of ordered raw readings: a longer reading replaces the best, whose zeros are stripped first."""

    def pick(best: Column, raw: Column) -> Column:
        r = F.regexp_replace(raw, "[^0-9]", "")
        bare = F.regexp_replace(r, "^0+", "")
        better = F.length(r).between(1, 4) & ((best == "") | (F.length(r) > F.length(best)))
        return F.when(better, F.when(bare == "", r).otherwise(bare)).otherwise(best)

    return F.aggregate(readings, F.lit(""), pick)


def clean_digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def clean_house(raw: Column) -> Column:
    """The fixed-grid variant: upper case, house characters only, O and I as digits."""
    return F.translate(F.regexp_replace(F.upper(raw), "[^A-Z0-9/-]", ""), "OI", "01")


def safe_int(raw: Column, default: int = -1) -> Column:
    number = raw.cast("string").try_cast("double")
    return F.coalesce(F.when(F.abs(number) < 2**31, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))).cast("int"), F.lit(default))


def has_photo_marker(s: Column) -> Column:
    return let(norm_for_match(s), lambda j: either([F.contains(j, F.lit(match_py(m))) for m in L.PHOTO_MARKERS]))


def is_stop_token(token: Column) -> Column:
    """Whether a token contains a stop label or is contained in one."""
    return let(norm_for_match(token), stops)


def stops(match: Column) -> Column:
    """Whether a value ends before the token of this norm_for_match, which no final colon changes: a stop token."""
    labels = sorted({match_py(s) for s in L.STOP_LABELS} - {""})
    # A normal form holds no line feed, so it is in a label if it is in the list of them.
    return (match != "") & (F.contains(F.lit("\n".join(labels)), match) | either([F.contains(match, F.lit(s)) for s in labels]))


def strip_name_label(value: Column) -> Column:
    s = strip(value)
    s = F.regexp_replace(s, rf"(?i)^(?:name)[{SPACE}]*{DASH}?[{SPACE}]*", "")
    return strip(F.regexp_replace(s, rf"^(?:பெயர்)[{SPACE}]*{DASH}?[{SPACE}]*", ""))


def value_after_colon(line: Column, label: str) -> Column:
    """What follows a label and at least one separator, cut at words of the photo line."""
    return value_of_normal(normalize_line(line), label)


def value_of_normal(line: Column, label: str) -> Column:
    """value_after_colon of a line in normal form."""
    pattern = rf"(?iu)(?:{label})\s*{DASH}?\s*{DASH}\s*(.+?)(?:\s*[\-–—]\s*$|\s*$)"

    def cut(found: Column) -> Column:
        value = F.regexp_replace(strip(found), r"\s*[\-–—]\s*$", "")
        return F.when(found != "", strip(F.regexp_replace(value, rf"(?iu)\s*(?:{L.VALUE_CUT}).*$", ""))).otherwise(found)

    return let(F.regexp_extract(line, pattern, 1), cut)


def folded(s: Column) -> Column:
    """Lower case in which all that equals a Latin letter but for its case is that letter."""
    return F.lower(F.translate(s, "İıſ\u212a", "iisk"))  # the optimiser makes lower(upper(s)) lower(s)


def clean_house_value(s: Column, longest: bool = False) -> Column:
    """The most digit-rich house-like token before a photo marker; ties go to the longer, then the first.

    ``longest`` is an older rule: the longest house-like token, else any token of up to twelve
    characters with a digit.
    """
    marks = [match_py(m) for m in L.PHOTO_MARKERS]

    def position(norm: Column) -> Column:
        spots = F.array(*[F.instr(norm, F.lit(m)) for m in marks])
        return F.array_min(F.filter(spots, lambda p: p > 0))

    at = position(norm_for_match(s))
    head = F.when(at.isNotNull(), strip(F.substring(s, F.lit(1), at - 1))).otherwise(s)
    upper = F.translate(F.regexp_replace(F.upper(head), rf"[^A-Z0-9/\-{SPACE}]", " "), "OI", "01")
    bare = F.transform(F.split(upper, f"[{SPACE}]+"), lambda t: F.regexp_replace(t, "^[/-]+|[/-]+$", ""))
    clean = F.filter(bare, lambda t: ~either([F.contains(t, F.lit(b)) for b in L.HOUSE_BAD_SUBSTRINGS]))
    good = F.filter(clean, lambda t: t.rlike(r"^[0-9][0-9A-Z/\-]{0,11}$"))
    digits = lambda t: F.lit(0) if longest else F.length(F.regexp_replace(t, "[^0-9]", ""))
    ranked = F.transform(good, lambda t, i: F.struct(digits(t).alias("d"), F.length(t).alias("n"), (-i).alias("i"), t.alias("t")))
    best = F.array_max(ranked)["t"]
    if longest:
        best = F.coalesce(best, F.get(F.filter(clean, lambda t: t.rlike("[0-9]") & (F.length(t) <= 12)), F.lit(0)))
    return F.coalesce(best, F.lit(""))


def map_gender(s: Column, strict: bool = False) -> Column:
    """The fallback's gender; compatible mode tests ``male`` first, so Female maps to Male."""
    g = F.lower(s)
    male = either([F.contains(g, F.lit(k)) for k in ("male", "ஆண்", "ஆண")])
    female = either([F.contains(g, F.lit(k)) for k in ("female", "பெண்", "பெண")])
    rest = F.when(strip(g) == "m", "Male").when(strip(g) == "f", "Female").otherwise("")
    chain = F.when(female, "Female").when(male, "Male") if strict else F.when(male, "Male").when(female, "Female")
    return F.when((s == "") | has_photo_marker(s), "").otherwise(chain.otherwise(rest))


def map_gender_raw(s: Column) -> Column:
    """The fixed-grid variant: unmapped values stay as they are."""
    g = F.lower(strip(s))
    male = either([F.contains(g, F.lit(k)) for k in ("male", "ஆண்", "ஆண")])
    female = either([F.contains(g, F.lit(k)) for k in ("female", "பெண்", "பெண")])
    return F.when(male, "Male").when(female, "Female").otherwise(strip(s))


def md_escape(value: Column) -> Column:
    s = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "\r\n?", "\n")
    return strip(F.replace(F.replace(s, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>")))


def yes_no(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit(False)), "Y").otherwise("N")


def safe_stem(stem: Column) -> Column:
    return F.regexp_replace(stem, r"[^\p{L}\p{N}\-_.]", "_")


def page_id(stem: Column) -> Column:
    return F.regexp_replace(stem, r"(?i)(?:[-_]img[-_]?\p{Nd}+)$", "")


def data_url(ext: Column, content: Column) -> Column:
    e = F.regexp_replace(F.lower(ext), r"^\.+", "")
    mime = F.when(e.isin("jpg", "jpeg"), "image/jpeg").otherwise(F.concat(F.lit("image/"), e))
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(content), "[\r\n]", ""))


def chat_url(base: Column) -> Column:
    u = F.regexp_replace(strip(F.coalesce(base, F.lit(""))), "/+$", "")
    return F.when(u.endswith("/openai"), F.concat(u, F.lit("/chat/completions"))).otherwise(u)


def sdk_base_url(base: Column) -> Column:
    u = F.regexp_replace(strip(F.coalesce(base, F.lit(""))), "/+$", "")
    bare = F.regexp_replace(F.regexp_replace(u, "/chat/completions$", ""), "/+$", "")
    return F.when(strip(F.coalesce(base, F.lit(""))) == "", "").otherwise(F.concat(bare, F.lit("/")))


def cost(prompt: Column, completion: Column, price_in: Column, price_out: Column, has_usage: Column) -> Column:
    """Price of the tokens; null without usage or without any price."""
    part = lambda tokens, price: F.when(price.isNotNull(), F.coalesce(tokens, F.lit(0)) / F.lit(1_000_000.0) * price).otherwise(F.lit(0.0))
    total = F.lit(0.0) + part(prompt, price_in) + part(completion, price_out)
    return F.when(has_usage & (price_in.isNotNull() | price_out.isNotNull()), total)
