"""Normalisation, stripping and tokenising."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.constants import NO_ANSWER, NO_ANSWER_VARIANT, WHITESPACE
from pairloom.functions import text
from pairloom.functions.tokens import python_tokenizer, whitespace_tokens

ZWNJ = "‌"


def apply(spark, fn, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, t string")
    return [r[0] for r in frame.orderBy("i").select(fn(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "fn, given_text, expected",
    [
        (text.fold_digits, "۱۲۳ ٤", "123 ٤"),
        (text.strip_punct, "a-b, c؟ «d»", "ab c «d»"),
        (text.strip_punct, string.punctuation + "،؛؟x", "x"),
        (text.canonical_no_answer, f"a {NO_ANSWER_VARIANT} b", f"a {NO_ANSWER} b"),
        (text.normalize_text, f"«{NO_ANSWER_VARIANT}»، ۱۲!", f"«{NO_ANSWER}» 12"),
        (text.strip, f"\t\n \x1c a{ZWNJ} b {ZWNJ}\x1f", f"a{ZWNJ} b {ZWNJ}"),
        (text.strip, "", ""),
    ],
)
def test_micro_cases(spark, fn, given_text, expected):
    assert apply(spark, fn, given_text) == [expected]


def test_whitespace_is_pythons(spark):
    """Strip and split agree with str on every candidate character."""
    others = "᠎​‌‍⁠﻿\x00\x7f­"
    samples = [f"{c}a{c}b{c}" for c in WHITESPACE + others]
    assert len(WHITESPACE) == 29
    assert apply(spark, text.strip, *samples) == [s.strip() for s in samples]
    assert apply(spark, whitespace_tokens, *samples) == [s.split() for s in samples]


def test_tokens_of_null_and_blank(spark):
    assert apply(spark, whitespace_tokens, None, "", " \n ") == [[], [], []]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n ‌ç۱", max_size=30), min_size=1, max_size=40))
def test_strip_and_split_properties(spark, samples):
    assert apply(spark, text.strip, *samples) == [s.strip() for s in samples]
    assert apply(spark, whitespace_tokens, *samples) == [s.split() for s in samples]


def test_user_tokenizer(spark):
    chars = python_tokenizer(list)
    assert apply(spark, chars, "abc", None, "") == [["a", "b", "c"], [], []]
