"""Optional token backend: a spaCy model, loaded once per Python worker, in place of the rules for tokens, spans and lemmas."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLOSED = {"DET", "ADP", "CCONJ", "SCONJ"}


def letter(token) -> str:
    """Class letter of a model token: punctuation and space, stop and closed-class words, numbers, nouns, adjectives, others.

    One letter holds one property, so a noun that is also a stop word counts as a stop word, as trimming would have it.
    """
    if token.is_punct or token.pos_ in ("PUNCT", "SPACE"):
        return "P"
    if token.is_stop or token.pos_ in CLOSED:
        return "S"
    if token.pos_ in ("NOUN", "PROPN"):
        return "N"
    if token.like_num or token.is_digit:
        return "D"
    return "A" if token.pos_ == "ADJ" else "V"


MODIFIERS = {"compound", "amod", "nmod"}
NOUNS = {"NOUN", "PROPN"}


def phrase_spans(doc, most: int) -> list[tuple[int, int]]:
    """(start, length), from 1: each noun with its left modifiers by the model's dependencies, of 2 to ``most`` tokens."""
    out = []
    for t in doc:
        if t.pos_ in NOUNS:
            left = [c.i for c in t.lefts if c.dep_ in MODIFIERS and c.pos_ in NOUNS | {"ADJ"}]
            if left and 1 < t.i + 1 - min(left) <= most:
                out.append((min(left) + 1, t.i + 1 - min(left)))
    return out


def load_model(name: str, lemmas: bool):
    """The model without what is not needed; ``ImportError`` with a hint if spaCy is not installed."""
    try:
        import spacy
    except ImportError as e:
        raise ImportError("the spacy token backend needs the package spacy and a model") from e
    return spacy.load(name, disable=["ner"] if lemmas else ["ner", "lemmatizer"])


def spacy_tokens(sections: DataFrame, model: str, most: int = 4, lemmas: bool = False, load: Callable | None = None) -> DataFrame:
    """Sections with ``toks, low, cls``, the model's ``model_chunks`` and ``model_phrases`` (start, length), and ``model_lemmas``.

    Lemmas replace nouns and adjectives only; proper nouns and all other tokens stay as they are. ``load(name, lemmas)`` gives
    the model in a worker; the default imports spaCy, here first, so that a missing package shows at once.
    """
    if load is None:
        try:
            import spacy  # noqa: F401
        except ImportError as e:
            raise ImportError("the spacy token backend needs the package spacy and a model") from e
        load = load_model
    spans = "ARRAY<STRUCT<st: INT, n: INT>>"

    @F.pandas_udf(f"toks ARRAY<STRING>, cls STRING, model_chunks {spans}, model_phrases {spans}, model_lemmas ARRAY<STRING>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        nlp = load(model, lemmas)
        for texts in batches:
            docs = list(nlp.pipe(texts))
            pairs = lambda found: [{"st": st, "n": n} for st, n in found]
            yield pd.DataFrame({
                "toks": [[t.text for t in d] for d in docs],
                "cls": ["".join(map(letter, d)) for d in docs],
                "model_chunks": [pairs((c.start + 1, c.end - c.start) for c in d.noun_chunks) for d in docs],
                "model_phrases": [pairs(phrase_spans(d, most)) for d in docs],
                "model_lemmas": [[t.lemma_ if lemmas and t.pos_ in ("NOUN", "ADJ") else t.text for t in d] for d in docs],
            })

    out = sections.withColumn("_p", parse("text")).drop("text").select("*", "_p.*").drop("_p")
    return out.withColumn("low", F.transform("toks", F.lower))
