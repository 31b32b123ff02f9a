"""Relevance tiers, and agreement of the keyword pattern with Python's word boundary."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.relevance import DEFAULT_CONFIG, RelevanceConfig, any_code_prefix, any_keyword, classify

CONFIG = RelevanceConfig(
    strong_keywords=("artificial intelligence", "machine learning", "ai", "llm"),
    weak_keywords=("algorithm", "automation"),
    strong_cpv_prefixes=("7222", "7223"),
    weak_cpv_prefixes=("7221", "4800"),
    version="t",
)
CASES = [
    ("Maintain Thai fulfillment centre", None, None, "none"),
    ("AI-powered triage", None, None, "strong"),
    ("New LLM service", None, None, "strong"),
    ("Machine Learning Pipeline", "", None, "strong"),
    (None, "Uses ARTIFICIAL INTELLIGENCE", [], "strong"),
    ("Algorithm work", None, ["72220000"], "strong"),
    ("Automation of forms", None, ["90911200"], "weak"),
    ("Automation of forms", None, ["72210000"], "weak"),
    ("Algorithms for all", None, None, "none"),
    ("Generic IT services", None, ["72230000"], "weak"),
    ("Generic IT services", None, ["1", "48001000"], "weak"),
    ("Office Cleaning Services", "Weekly cleaning", ["90911200"], "none"),
    ("machine", "learning", None, "strong"),
    (None, None, None, "none"),
]


def test_tiers(spark):
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(CASES)], "i int, t string, d string, c array<string>, want string"
    )
    got = df.select("i", "want", classify("t", "d", "c", CONFIG).alias("got")).orderBy("i").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def python_match(text: str, words) -> bool:
    return bool(re.search(rf"\b(?:{'|'.join(re.escape(w) for w in words)})\b", text.lower(), re.IGNORECASE))


TRICKY = ["éai", "ai²", "ai_x", "_ai", "AI", "aİ", "aı", "ſentiment analyſiſ", "ai٣", "x ai", "ai.", "a i", "ＡＩ", "aí", "K ai K"]


def test_word_boundary_equals_python(spark):
    texts = TRICKY + [f"x{t}" for t in TRICKY] + [f"{t} z" for t in TRICKY]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", any_keyword(F.lower("t"), fixed.STRONG_KEYWORDS)).collect()}
    assert got == {t: python_match(t, fixed.STRONG_KEYWORDS) for t in texts}


WORDS = ["ai", "llm", "machine learning", "c3po", "über plan", "a.b"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["ai", "llm", "machine", "learning", "über", "plan", "a.b", "axb", " ", "-", "é", "_", "7", "ı"]), max_size=6).map("".join), min_size=30, max_size=60))
def test_random_texts_equal_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for words in (tuple(WORDS[:4]), tuple(WORDS)):
        got = [r[0] for r in df.select(any_keyword(F.lower("t"), words)).collect()]
        assert got == [python_match(t, words) for t in texts]


def test_words_after_odd_characters(spark):
    texts = ["\U0001d400ai", "\U0001f600ai", "\U0001f600 ai\U0001d400", "line\nai", "\tai", "aiai ai", "\u2028ai", "mai\u0301 ai\u0301", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = [False, True, False, True, True, True, True, True, False, False]
    for words in (("ai",), ("ai", "über")):
        got = [r[0] for r in df.orderBy("i").select(any_keyword(F.lower("t"), words)).collect()]
        assert got == want


def test_texts_without_keywords_are_searched_once(spark, capsys):
    """The first branch looks for both kinds of words, and only where a word may begin."""
    spark.createDataFrame([("a", "b")], "t string, d string").select(classify("t", "d").alias("tier")).explain()
    plan = capsys.readouterr().out
    first = plan[plan.index("RLIKE(") : plan.index("THEN")]
    assert "eural network" in first and "lgor[iı]thm" in first and first.count("RLIKE") == 1
    assert "(?<!" not in plan


def test_empty_lists_and_null_codes(spark):
    df = spark.createDataFrame([(None,), ([],), (["7222"],), ([None, "1"],)], "c array<string>")
    assert [r[0] for r in df.select(any_code_prefix("c", ("72",))).collect()] == [False, False, True, False]
    assert [r[0] for r in df.select(any_code_prefix("c", ())).collect()] == [False] * 4
    assert df.select(any_keyword(F.lit("ai"), ())).first()[0] is False


def test_config_is_checked():
    with pytest.raises(ValueError):
        RelevanceConfig(strong_keywords=("c++",))
    assert DEFAULT_CONFIG.version == "2.0" and len(DEFAULT_CONFIG.strong_keywords) == 27
