"""Problem 10: one consistent form for text that looks the same, by script-aware repair against the corpus vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..plans.storage import materialize
from .characters import is_mixed, plain, pure_words, replace_words, suspects


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct one-script words of plain texts without their case, folded within each task while the set stays bounded."""
    seen: set[str] = set()
    for b in batches:
        new = set()
        for text in b.column(0).to_pylist():
            if text:
                new |= {w.casefold() for w in pure_words(text)}
        new -= seen
        if len(seen) > 500_000:
            seen.clear()
        seen |= new
        yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.string())], ["known"])


def _normalised(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, canonical, odd``: each text in plain form, and its suspect words with their possible repairs."""
    kind = docs.schema[key].dataType.simpleString()
    entry = pa.list_(pa.struct([("word", pa.string()), ("form", pa.string()), ("known", pa.string()), ("choice", pa.int32()), ("mixed", pa.bool_())]))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else plain(t) for t in b.column(1).to_pylist()]
            odd = [[(w, f, f.casefold(), i, is_mixed(w)) for w, forms in suspects(t).items() for i, f in enumerate(forms)] if t else [] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(odd, entry)], [key, "text", "canonical", "odd"])

    schema = f"`{key}` {kind}, text STRING, canonical STRING, odd ARRAY<STRUCT<word: STRING, form: STRING, known: STRING, choice: INT, mixed: BOOLEAN>>"
    return docs.select(key, F.col(text).alias("text")).mapInArrow(normal, schema)


def word_repairs(rows: DataFrame) -> DataFrame:
    """``word, form``: for each mixed-script word of normalised rows the form to write instead.

    Accepted is the first of its possible forms, that of its dominant script before others, that the corpus has as a word of
    one script, in any case. Both sides are distinct before they are joined; the vocabulary is never collected.
    """
    odd = rows.filter(F.size("odd") > 0).select(F.inline("odd")).filter("mixed").distinct()
    known = rows.select("canonical").mapInArrow(_vocabulary, "known STRING").join(odd.select("known").distinct(), "known", "left_semi").distinct()
    return odd.join(known, "known").groupBy("word").agg(F.min_by("form", "choice").alias("form"))


def canonical_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, canonical`` of every row (``key`` unique and not null); a null text stays null.

    Invisible characters go, single gaps become spaces, full-width and mathematical forms, ligatures and composed letters
    get their ordinary form; then mixed-script words are repaired by :func:`word_repairs`. Case, accents and raised digits
    stay. A second step takes words that the first leaves: those written wholly in look-alikes of another script than
    their text's, and mixed ones the vocabulary lacks. They may well be meant, as a quoted foreign word is, so they
    are repaired only where that makes the text the same as another document's, which is written otherwise.
    The plain form is computed once and written to the shared folder. Only rows with such words take part in the joins;
    all others pass as they are.
    """
    rows = materialize(_normalised(docs, key, text), "normal")
    kind = docs.schema[key].dataType.simpleString()
    some = rows.filter(F.size("odd") > 0)
    words = some.select(key, F.explode(F.array_distinct(F.col("odd.word"))).alias("word")).join(word_repairs(rows), "word")
    per_row = words.groupBy(key).agg(F.collect_list(F.struct("word", "form")).alias("repairs"))  # at most the row's words

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = [], []
            for t, odd, repairs in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                table = {r["word"]: r["form"] for r in repairs or ()}
                rest = {r["word"]: r["form"] for r in odd if r["choice"] == 0 and r["word"] not in table}
                one.append(replace_words(t, table))
                two.append(replace_words(t, table | rest) if rest else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(one, pa.string()), pa.array(two, pa.string())], [key, "text", "canonical", "further"])

    joined = some.select(key, "text", "canonical", "odd").join(per_row, key, "left")
    fixed = materialize(joined.mapInArrow(repaired, f"`{key}` {kind}, text STRING, canonical STRING, further STRING"), "fixed")
    easy = rows.filter(F.coalesce(F.size("odd") <= 0, F.lit(True))).select(key, "text", "canonical")

    digest = lambda c: F.unhex(F.md5(c))
    wanted = fixed.filter("further is not null").select(digest(F.col("further")).alias("look")).distinct()
    looks = easy.select(digest(F.col("canonical")).alias("look"), digest(F.col("canonical")).alias("own")).union(
        fixed.select(digest(F.coalesce("further", "canonical")).alias("look"), digest(F.col("canonical")).alias("own"))
    )
    proven = looks.join(wanted, "look", "left_semi").groupBy("look").agg((F.min("own") != F.max("own")).alias("two")).filter("two").select("look", "two")
    done = fixed.withColumn("look", digest(F.col("further"))).join(proven, "look", "left")
    return easy.union(done.select(key, "text", F.when(F.col("two"), F.col("further")).otherwise(F.col("canonical")).alias("canonical")))


def look_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that look like others which are written otherwise, one row each.

    ``class_id`` is the least document of the same look, ``spelling_id`` the least with the very same characters;
    ``class_size`` counts the class's documents, ``n_spellings`` its spellings, ``links`` its documents written otherwise than
    this one. Blank texts and looks of one spelling have no class. Rows are reduced to two 128-bit digests before
    anything is shuffled, and counts combine map-side, so a look of any number of copies is no burden.
    """
    c = canonical_texts(docs.filter(F.col(key).isNotNull()), key, text).filter(~is_blank(F.col("canonical")))
    rows = materialize(c.select(F.col(key).alias("doc"), F.unhex(F.md5("canonical")).alias("look"), F.unhex(F.md5("text")).alias("spelling")), "looks")
    spellings = rows.groupBy("look", "spelling").agg(F.min("doc").alias("spelling_id"), F.count(F.lit(1)).alias("n"))
    looks = spellings.groupBy("look").agg(F.min("spelling_id").alias("class_id"), F.sum("n").alias("class_size"), F.count(F.lit(1)).alias("n_spellings")).filter("n_spellings > 1")
    classed = spellings.join(looks, "look")
    out = rows.join(classed, ["look", "spelling"])
    return out.select(F.col("doc").alias(key), "class_id", "spelling_id", "class_size", "n_spellings", (F.col("class_size") - F.col("n")).alias("links"))


def same_looking(docs: DataFrame, key: str = "doc_id", text: str = "text", part: int = 1000) -> DataFrame:
    """``doc_id_a, doc_id_b`` (smaller first): texts that are not blank, look the same, and differ in their characters.

    The classes of :func:`look_classes` expanded to pairs. A class is dealt to parts of about ``part`` documents on one side,
    and goes to every part on the other, so that a class of any size is spread over tasks.
    """
    rows = materialize(look_classes(docs, key, text).select(F.col(key).alias("doc"), "class_id", "spelling_id", F.ceil(F.col("class_size") / part).alias("parts")), "classes")
    side = lambda x: rows.select("class_id", "parts", F.col("doc").alias(f"doc_id_{x}"), F.col("spelling_id").alias(f"s_{x}"))
    a = side("a").withColumn("p", F.pmod(F.xxhash64("doc_id_a"), F.col("parts"))).drop("parts")
    b = side("b").withColumn("p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
    return a.join(b, ["class_id", "p"]).filter("doc_id_a < doc_id_b and s_a <> s_b").select("doc_id_a", "doc_id_b")
