import re

from pyspark.sql import functions as F

from usagelake.llm import mixing
from usagelake.llm.common import word_count

TEXTS = ["", " ", "\t\n\x0b\x0c\r ", "a", " a", "a ", "a b", "\n\na\t\tb\x0b c\x0c\r", "x y z", " ", "\U0001f600 \U0001f600\U0001f600", "\x1c a\x1f \x85 b", "$1 \\ w", None, "a " * 5000]


def test_words_are_counted_as_runs(spark):
    got = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").select("i", word_count(F.col("text")).alias("n"))
    want = {i: None if t is None else len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(TEXTS)}
    assert {r.i: r.n for r in got.collect()} == want


def test_no_list_of_all_words_of_a_text_is_made(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = mixing.with_leaf(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan.lower() and "regexp_count" not in plan.lower()
