"""The first JSON value in a model's answer, and the metadata document around it."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.text import cost, strip


def first_json(text: str | None):
    """The value and True; None and False if there is none.

    A code fence at the start goes.  The whole text is tried first, so a bare number counts;
    then, from each opening bracket, the balanced stretch that respects strings.
    """
    if text is None:
        return None, False
    body = text.strip()
    if body.startswith("```"):
        body = re.sub(r"\s*```$", "", re.sub(r"^```[a-zA-Z0-9_-]*\s*", "", body)).strip()
    try:
        return json.loads(body), True
    except ValueError:
        pass
    for opening in re.finditer(r"[\[{]", body):
        end = _balanced(body, opening.start())
        if end:
            try:
                return json.loads(body[opening.start() : end]), True
            except ValueError:
                continue
    return None, False


_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]|"', re.S)


def _balanced(text: str, start: int) -> int:
    """End of the bracketed stretch that begins at ``start``; 0 if it does not close properly."""
    want: list[str] = []
    for m in _MARK.finditer(text, start):
        mark = m[0]
        if mark in ("{", "["):
            want.append("}" if mark == "{" else "]")
        elif mark in ("}", "]"):
            if want.pop() != mark:
                return 0
            if not want:
                return m.end()
        elif mark == '"':
            return 0
    return 0


def unfenced(content: Column) -> Column:
    t = strip(content)
    inner = strip(F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z0-9_-]*\s*", ""), r"\s*```$", ""))
    return F.when(t.startswith("```"), inner).otherwise(t)


def repair(rows: DataFrame, content: str = "content") -> DataFrame:
    """``rows`` with json (text of the value) and parsed.

    Native where the unfenced text is JSON as it stands; only the rest goes through Python,
    as a scan that respects strings is no regular expression.
    """
    whole = rows.withColumn("_t", unfenced(F.col(content)))
    easy = F.col("_t").rlike(r"^[\[{]") & F.try_parse_json("_t").isNotNull()
    native = whole.where(easy).withColumn("json", F.to_json(F.parse_json("_t"))).withColumn("parsed", F.lit(True)).drop("_t")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [first_json(v) for v in frame[content]]
            yield frame.assign(json=[json.dumps(v, ensure_ascii=False, separators=(",", ":")) if ok else None for v, ok in made], parsed=[ok for _, ok in made])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["json string", "parsed boolean"])
    return native.unionByName(whole.where(~F.coalesce(easy, F.lit(False))).drop("_t").mapInPandas(run, schema))


def merged(document: Column, ai_metadata: Column) -> Column:
    """The document with ai_metadata where it has none or an empty one; anything but an object is wrapped as data."""
    is_object = strip(document).startswith("{")
    wrapped = F.concat(F.lit('{"data":'), document, F.lit(',"ai_metadata":'), F.to_json(ai_metadata), F.lit("}"))
    own = F.get_json_object(document, "$.ai_metadata")
    empty = own.isNull() | own.isin("", "{}", "[]", "null", "false", "0")
    body = F.regexp_replace(strip(document), r"\}$", "")
    comma = F.when(body.rlike(r"^\{\s*$"), "").otherwise(",")
    added = F.concat(body, comma, F.lit('"ai_metadata":'), F.to_json(ai_metadata), F.lit("}"))
    return F.when(~is_object, wrapped).when(empty, added).otherwise(document)


def ai_metadata(provider: str, base_url: str, model: str, pricing: dict, prompt: Column, completion: Column, total: Column) -> Column:
    usage = prompt.isNotNull() | completion.isNotNull() | total.isNotNull()
    price = lambda k: F.lit(pricing[k]).cast("double")
    value = cost(prompt, completion, price("input_cost_per_1m_tokens"), price("output_cost_per_1m_tokens"), usage)
    return F.struct(
        F.lit(provider).alias("provider"), F.lit(base_url).alias("base_url"), F.lit(model).alias("model"),
        F.struct(F.lit(pricing["currency"]).alias("currency"), price("input_cost_per_1m_tokens").alias("input_cost_per_1m_tokens"), price("output_cost_per_1m_tokens").alias("output_cost_per_1m_tokens")).alias("pricing"),
        F.when(usage, F.struct(prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), total.alias("total_tokens"))).alias("usage"),
        F.when(value.isNotNull(), F.struct(F.lit(pricing["currency"]).alias("currency"), value.alias("value"))).alias("estimated_cost"),
    )
