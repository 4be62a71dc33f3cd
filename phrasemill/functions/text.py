"""Scalar text expressions: stripping, formatting, block keys, chunk names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Formatter = Callable[..., Column]
_FORMATTERS: dict[str, Formatter] = {}


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any ASCII kind (``trim`` alone removes only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Stripped, with each run of white space as one space."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only values; never null."""
    return F.coalesce(~c.rlike(r"\S"), F.lit(True))


def block_key(c: Column) -> Column:
    """First white-space token, or ``__empty__`` for null and blank values."""
    return F.coalesce(F.nullif(F.split_part(collapse(c), F.lit(" "), F.lit(1)), F.lit("")), F.lit("__empty__"))


def starts_with_pattern(c: Column, pattern: str) -> Column:
    """Regular-expression predicate in which null counts as false."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def chunk_name(chunk: Column, width: int = 4) -> Column:
    """``chunk_0007`` from 7; longer numbers keep all their digits."""
    digits = chunk.cast("string")
    return F.concat(F.lit("chunk_"), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def register_formatter(name: str) -> Callable[[Formatter], Formatter]:
    """Decorator: make a ``(title, abstract, **options) -> Column`` builder available under ``name``."""

    def add(fn: Formatter) -> Formatter:
        _FORMATTERS[name] = fn
        return fn

    return add


def get_formatter(mode: str) -> Formatter:
    """The formatter registered as ``mode``; ``ValueError`` naming the known ones otherwise."""
    if mode not in _FORMATTERS:
        raise ValueError(f"unknown format mode {mode!r}; available: {sorted(_FORMATTERS)}")
    return _FORMATTERS[mode]


def _part(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


@register_formatter("cls_sep")
def format_cls_sep(title: Column, abstract: Column, cls_token: str = "[CLS]", sep_token: str = "[SEP]") -> Column:
    """``[CLS] t [SEP] a``; without an abstract ``[CLS] t``; without a title ``[CLS] [SEP] a``; neither gives ``''``."""
    t, a = _part(title), _part(abstract)
    tail = F.when(a.isNotNull(), F.concat_ws(" ", F.lit(sep_token), a))
    return F.when(t.isNull() & a.isNull(), F.lit("")).otherwise(F.concat_ws(" ", F.lit(cls_token), t, tail))


@register_formatter("plain")
def format_plain(title: Column, abstract: Column, **_: str) -> Column:
    """``t. a``, or whichever part exists, or ``''``."""
    return F.concat_ws(". ", _part(title), _part(abstract))


def format_documents(df: DataFrame, mode: str = "cls_sep", **options: str) -> DataFrame:
    """``row_id, doc_text`` of every row of ``df`` (columns ``row_id, title, abstract``)."""
    return df.select("row_id", get_formatter(mode)(F.col("title"), F.col("abstract"), **options).alias("doc_text"))
