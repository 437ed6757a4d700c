"""Records are assembled in one pass; lines that cannot hold a label are left out of its search only where it finds nothing."""

import pytest
from pyspark.sql import functions as F

from docengine import queries as Q
from docengine.functions import fields, text as T
from docengine.plans import records as R

DATA = "/root/testdata/sf0.001"
ODD = [
    ("HOUſE NO : 12/a", "12/a", "", "", ""), ("Houſe Number - 7 avaılable", "7", "", "", ""), ("house : 9 İs it", "9", "", "", ""), ("AGE : 45 GENDER : M", "", "45", "Male", ""), (" வீட்டு  எண் : ௧௨ Photo", "௧௨", "", "", ""),
    ("FATHER'S NAME : Ā B -", "", "", "", "Ā B"), ("HUſBAND : c", "", "", "", "c"), ("‌தாய்பெயர் :: ப", "", "", "", "ப"), ("house", "", "", "", ""), ("​ ‍age‍ 4", "", "4", "", ""), ("", "", "", "", ""),
]


@pytest.mark.parametrize(("line", "house", "age", "gender", "relation"), ODD)
def test_lines_with_odd_letters(spark, line, house, age, gender, relation):
    lines = F.array(F.lit(None).cast("string"), F.lit(line))
    row = R.with_line_fields(spark.range(1), lines).select("house_no", "age", "gender", "relation.name").head()
    assert tuple(row) == (house, age, gender, relation)
    own = spark.range(1).select(fields.house_of(lines), fields.age_of(lines), fields.gender_of(lines), fields.relation_of(lines)["name"]).head()
    assert tuple(own) == tuple(row)


def test_a_final_colon_changes_no_stop(spark):
    rows = spark.createDataFrame([("பெயர்:",), ("Name:",), ("x:",), (":",), ("0ther:",), ("Σ:",), ("a‍ge",), ("ΑΣ:",)], "t string")
    got = rows.select(T.is_stop_token(F.col("t")), T.is_stop_token(F.regexp_replace("t", ":$", "")), T.normalize_text(F.col("t")), T.normalize_text(F.regexp_replace("t", ":$", ""))).collect()
    assert all(a == b and c == d for a, b, c, d in got) and [g[0] for g in got] == [True, True, False, False, True, False, True, False]


def test_records_are_read_once(spark):
    plan = Q.words_records(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Scan parquet") == 4  # customer and nation, for lines and for words
