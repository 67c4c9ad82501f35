from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake.functions import (
    anonymize,
    clean_category,
    clean_identifier,
    clean_text,
    fold_accents,
    is_blank,
    strip_symbols,
)


def apply(spark, function, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_accents(spark):
    text = "Ação útil côncavo ó ç ÁÉÍÓÚÇ"
    assert apply(spark, fold_accents, text) == ["Acao util concavo o c AEIOUC"]
    legacy = apply(spark, lambda c: fold_accents(c, legacy_map=True), "Ação", "ú ü ç")
    assert legacy == ["Auao", "o u u"]


def test_symbols(spark):
    """Symbols, combining accents and no-break spaces go; plain punctuation stays."""
    texts = ["bom 👍🏽 $5 + ok_ ~", "a\u00a0b", "e\u0301", "(a) - b; c! #1", None]
    assert apply(spark, strip_symbols, *texts) == ["bom  5  ok_ ", "ab", "e", "(a) - b; c! #1", None]


def test_text_is_cleaned_in_order(spark):
    assert apply(spark, clean_text, "  coração ❤ bom!  ", "   ", "👍", None) == [
        "CORACAO  BOM!", "", "", None]


def test_identifier(spark):
    assert apply(spark, clean_identifier, "123.456.789-00", "12 3/4", "ab-c") == [
        "12345678900", "1234", "ABC"]


def test_category_replaces_whitespace_before_trimming(spark):
    assert apply(spark, clean_category, " cartão  de\tcrédito ", "seguro") == [
        "_CARTÃO_DE_CRÉDITO_", "SEGURO"]


def test_anonymize(spark):
    plain, salted = (apply(spark, lambda c: anonymize(c, salt), "x")[0] for salt in ("", "s"))
    assert len(plain) == 64 and plain != salted
    assert apply(spark, anonymize, None) == [None]


def test_blank(spark):
    assert apply(spark, is_blank, None, "", "   ", "\t", "x") == [True, True, True, False, False]


LATIN = st.one_of(st.characters(max_codepoint=0xFF), st.sampled_from("👍★–\u0301 "))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(LATIN, max_size=30), min_size=1, max_size=20))
def test_cleaning_twice_changes_nothing(spark, texts):
    once = apply(spark, clean_text, *texts)
    assert apply(spark, clean_text, *once) == once


@pytest.mark.parametrize("text", ["Größe", "STRASSE"])
def test_sharp_s_has_two_capitals(spark, text):
    assert apply(spark, clean_text, text) in (["GROSSE"], ["STRASSE"])
