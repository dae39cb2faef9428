import re

from hypothesis import given, settings
from hypothesis import strategies as st

from editlens.config import STOP_WORDS
from editlens.functions import keyword_tokens


def py_tokens(s):
    if not s:
        return []
    return [w for w in re.findall(r"[a-zA-Z]{3,}", s.lower()) if w not in STOP_WORDS]


PIECES = st.sampled_from(list("abcXYZ THE the of_and-é ü日本 Kİ12:Ä") + ["The ", " and "])
TEXTS = st.lists(PIECES, max_size=25).map("".join)


@settings(max_examples=30, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=20))
def test_tokens_match_python_twin(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: list(r.k or []) for r in df.select("i", keyword_tokens("t").alias("k")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_tokens(t), t


def test_tokens_examples(spark):
    df = spark.createDataFrame([("The Apache Spark and the Lambda_architecture",), (None,), ("",)],
                               "t string")
    got = [r.k for r in df.select(keyword_tokens("t").alias("k")).collect()]
    assert got[0] == ["apache", "spark", "lambda", "architecture"]
    assert got[1] is None and got[2] == []


def test_tokenizer_plan_has_no_python(spark):
    df = spark.createDataFrame([("abc def",)], "t string").select(keyword_tokens("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
