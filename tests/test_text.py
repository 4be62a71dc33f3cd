import pytest
from pyspark.sql import functions as F

from phrasemill.functions.embedding import get_embedder
from phrasemill.functions.text import block_key, chunk_name, collapse, format_documents, get_formatter, is_blank, register_formatter, starts_with_pattern
from phrasemill.functions.tokens import class_string, lemma, lemma_key, tokenize
from phrasemill.functions.vectors import dot, is_usable, norm, unit


def one(spark, column, value, kind="STRING"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("t", "a", "cls", "plain"),
    [("T", "A", "[CLS] T [SEP] A", "T. A"), ("T", None, "[CLS] T", "T"), (" ", "A", "[CLS] [SEP] A", "A"), (None, None, "", ""), ("\tT\n", " A ", "[CLS] T [SEP] A", "T. A")],
)
def test_document_formats(spark, t, a, cls, plain):
    df = spark.createDataFrame([(1, t, a)], "row_id BIGINT, title STRING, abstract STRING")
    assert format_documents(df, "cls_sep").first()["doc_text"] == cls
    assert format_documents(df, "plain").first()["doc_text"] == plain


def test_formatter_registry(spark):
    with pytest.raises(ValueError, match="cls_sep"):
        get_formatter("nothing")
    register_formatter("upper_title")(lambda t, a, **_: F.upper(t))
    assert format_documents(spark.createDataFrame([(1, "x", "y")], "row_id INT, title STRING, abstract STRING"), "upper_title").first()["doc_text"] == "X"


def test_scalars(spark):
    assert [one(spark, block_key, v) for v in ("solid state cell", "  two\twords", "", None, " ")] == ["solid", "two", "__empty__", "__empty__", "__empty__"]
    assert one(spark, collapse, " a \t b\n") == "a b"
    assert [one(spark, is_blank, v) for v in (None, "", " \t\n", "x")] == [True, True, True, False]
    assert one(spark, chunk_name, 7, "INT") == "chunk_0007"
    assert [one(spark, lambda c: starts_with_pattern(c, "^batter"), v) for v in ("battery", "a battery", None)] == [True, False, False]


def test_tokens_and_classes(spark):
    assert one(spark, tokenize, "Solid-state cell, 3.5 V!") == ["Solid", "-", "state", "cell", ",", "3", ".", "5", "V", "!"]
    assert one(spark, lambda c: tokenize(c, "keep"), "Solid-state cell") == ["Solid-state", "cell"]
    assert one(spark, lambda c: class_string(F.transform(tokenize(c), F.lower)), "The porous electrode comprises 3 cells.") == "SANVDNP"
    assert one(spark, lambda c: class_string(F.transform(tokenize(c), F.lower)), "") == ""
    with pytest.raises(ValueError):
        tokenize(F.lit("x"), "drop")


def test_lemmas(spark):
    words = {"batteries": "battery", "cells": "cell", "gases": "gase", "glass": "glass", "bus": "bus", "Plates": "plate", "series": "sery", "ion": "ion"}
    assert {w: one(spark, lemma, w) for w in words} == words
    assert one(spark, lemma_key, "Lithium Batteries") == "lithium battery"
    assert one(spark, lemma_key, None) == ""


def test_vectors(spark):
    assert one(spark, lambda c: dot(c, c), [3.0, 4.0], "ARRAY<FLOAT>") == 25.0
    assert one(spark, norm, [3.0, 4.0], "ARRAY<FLOAT>") == 5.0
    assert one(spark, unit, [0.0, 0.0], "ARRAY<DOUBLE>") == [0.0, 0.0]
    bad = [None, [], [0.0, 0.0], [1.0, float("nan")], [1.0, None], [float("inf"), 1.0], [1.0]]
    assert [one(spark, lambda c: is_usable(c, 2), v, "ARRAY<FLOAT>") for v in [*bad, [1.0, 0.0]]] == [False] * 7 + [True]


def test_hashed_embedder(spark):
    df = spark.createDataFrame([("battery cell",), ("Battery Cell",), ("",), (None,), ("ab",)], "t STRING").withColumn("v", get_embedder().embed(F.col("t")))
    a, b, *zero = [r.v for r in df.collect()]
    assert a == b and abs(sum(x * x for x in a) - 1) < 1e-9
    assert all(set(z) == {0.0} for z in zero)
    with pytest.raises(ValueError, match="hashed"):
        get_embedder("none")
    with pytest.raises(ImportError, match="sentence-transformers"):
        get_embedder("sentence_transformers")
