"""Candidate extraction: sections, tokens, span sources, trimming, filtering, normalisation, per-section merge.

Everything up to the merge is one narrow stage: a section's tokens and class letters stay in arrays, spans are cut
and tested on the class string, and only spans that survive become rows. When the input is hash partitioned by
``row_id`` (as :func:`phrasemill.sources.tables.latest_revision` leaves it), the merge needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..functions.text import is_blank, strip
from ..functions.tokens import class_string, lemma, tokenize

SECTIONS = ("title", "abstract")
SOURCES = ("noun_chunk", "dep_phrase", "ngram")

#: Span sources: name -> builder of an array of (start, length) over the class string, 1-based. Users may add more.
SPAN_SOURCES: dict[str, Callable[[Column, ExtractConfig], Column]] = {}


def register_span_source(name: str):
    """Decorator: add a span source; it is used whenever its name is in ``enabled_sources``."""

    def add(fn):
        SPAN_SOURCES[name] = fn
        return fn

    return add


def _span(start: Column, n: Column) -> Column:
    return F.struct(start.cast("int").alias("st"), n.cast("int").alias("n"))


def _positions(cls: Column) -> Column:
    return F.when(F.length(cls) > 0, F.sequence(F.lit(1), F.length(cls))).otherwise(F.array().cast("array<int>"))


@register_span_source("noun_chunk")
def noun_chunks(cls: Column, cfg: ExtractConfig) -> Column:
    """Maximal runs of adjectives and nouns that end in a noun, in document order."""
    starts = F.filter(
        _positions(cls),
        lambda i: F.substr(cls, i, F.lit(1)).isin("A", "N") & ((i == 1) | ~F.substr(cls, i - 1, F.lit(1)).isin("A", "N")),
    )
    runs = F.transform(starts, lambda i: _span(i, F.length(F.regexp_extract(F.substr(cls, i), "^[AN]*N", 0))))
    return F.filter(runs, lambda s: s["n"] > 0)


@register_span_source("dep_phrase")
def dependency_phrases(cls: Column, cfg: ExtractConfig) -> Column:
    """For each noun, the adjectives and nouns directly to its left and itself; longer than the maximum: dropped."""
    most = cfg.max_candidate_length
    heads = F.filter(_positions(cls), lambda j: F.substr(cls, j, F.lit(1)) == "N")
    before = lambda j: F.substr(cls, F.greatest(F.lit(1), j - most), F.least(j - 1, F.lit(most)))
    runs = F.transform(heads, lambda j: F.struct(j.alias("j"), F.length(F.regexp_extract(before(j), "[AN]+$", 0)).alias("m")))
    kept = F.filter(runs, lambda r: (r["m"] >= 1) & (r["m"] < most))
    return F.transform(kept, lambda r: _span(r["j"] - r["m"], r["m"] + 1))


@register_span_source("ngram")
def ngrams(cls: Column, cfg: ExtractConfig) -> Column:
    """All windows of ``ngram_min`` to ``ngram_max`` tokens that hold a noun, shorter ones first."""
    sizes = range(cfg.ngram_min, min(cfg.ngram_max, cfg.max_candidate_length) + 1)
    windows = [F.transform(F.filter(_positions(cls), lambda i: i <= F.length(cls) - n + 1), lambda i: _span(i, F.lit(n))) for n in sizes]
    if not windows:
        return F.array().cast("array<struct<st:int,n:int>>")
    return F.filter(F.concat(*windows), lambda s: F.instr(F.substr(cls, s["st"], s["n"]), "N") > 0)


def enabled_sources(cfg: ExtractConfig) -> list[str]:
    """The span sources that the configuration switches on, in their fixed order, then any that users added."""
    on = dict(zip(SOURCES, (cfg.use_noun_chunks, cfg.use_dependency_phrases, cfg.use_ngram_backoff)))
    return [s for s in SOURCES if on[s]] + [s for s in SPAN_SOURCES if s not in on]


def sections(df: DataFrame) -> DataFrame:
    """``row_id, section_ord, source_section, text``: stripped, without null and blank sections, from one scan.

    ``ValueError`` if the table has neither a title nor an abstract.
    """
    present = [s for s in SECTIONS if s in df.columns]
    if not present:
        raise ValueError(f"no text column: need one of {list(SECTIONS)}; found {df.columns}")
    parts = F.array(*[F.struct(F.lit(SECTIONS.index(s)).alias("section_ord"), F.lit(s).alias("source_section"), F.col(s).alias("text")) for s in present])
    out = df.select("row_id", F.inline(parts)).filter(~is_blank(F.col("text")))
    return out.withColumn("text", strip(F.col("text")))


def tokens(df: DataFrame, cfg: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Sections with ``toks``, ``low`` (the same in lower case) and ``cls`` (one letter per token)."""
    if cfg.nlp_backend == "spacy":
        from ..functions.spacy_backend import spacy_tokens

        return spacy_tokens(sections(df), cfg.spacy_model, cfg.max_candidate_length, cfg.lemmatize)
    if cfg.nlp_backend != "rules":
        raise ValueError(f"unknown token backend {cfg.nlp_backend!r}; available: ['rules', 'spacy']")
    out = sections(df).withColumn("toks", tokenize(F.col("text"), cfg.hyphen)).drop("text")
    return out.withColumn("low", F.transform("toks", F.lower)).withColumn("cls", class_string(F.col("low")))


def _all_spans(cfg: ExtractConfig) -> Column:
    def tagged(name: str) -> Column:
        k = list(SPAN_SOURCES).index(name)
        at = lambda s, i: F.struct(F.lit(k).alias("so"), F.lit(name).alias("tag"), i.alias("i"), s["st"].alias("st"), s["n"].alias("n"))
        model = {"noun_chunk": "model_chunks", "dep_phrase": "model_phrases"} if cfg.nlp_backend == "spacy" else {}
        return F.transform(F.col(model[name]) if name in model else SPAN_SOURCES[name](F.col("cls"), cfg), at)

    per_source = [tagged(name) for name in enabled_sources(cfg)]
    return F.concat(*per_source) if per_source else F.array().cast("array<struct<so:int,tag:string,i:int,st:int,n:int>>")


def spans(df: DataFrame, cfg: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Raw spans before trimming: ``row_id, source_section, source, span_ord, start, len``."""
    flat = tokens(df, cfg).select("row_id", "source_section", F.explode(_all_spans(cfg)).alias("s"))
    return flat.select("row_id", "source_section", F.col("s.tag").alias("source"), F.col("s.i").alias("span_ord"), F.col("s.st").alias("start"), F.col("s.n").alias("len"))


def _trimmed(spans_: Column) -> Column:
    """Stop words and punctuation cut from both ends: start and class letters of what is left."""
    cls = F.col("cls")
    cut = F.transform(spans_, lambda s: F.struct(s["so"].alias("so"), s["tag"].alias("tag"), s["i"].alias("i"), s["st"].alias("st"), F.substr(cls, s["st"], s["n"]).alias("c")))
    return F.transform(
        cut,
        lambda s: F.struct(
            s["so"].alias("so"), s["tag"].alias("tag"), s["i"].alias("i"),
            (s["st"] + F.length(s["c"]) - F.length(F.ltrim(s["c"], F.lit("SP")))).alias("st"),
            F.trim(s["c"], F.lit("SP")).alias("core"),
        ),
    )


def _passes(core: Column, cfg: ExtractConfig) -> Column:
    return (
        (F.instr(core, "N") > 0)
        & F.length(core).between(cfg.min_candidate_length, cfg.max_candidate_length)
        & (F.instr(core, "P") == 0)
        & ~core.rlike("^D+$")
    )


def _norm_tokens(cfg: ExtractConfig) -> Column:
    cls, words = F.col("cls"), F.col("low" if cfg.lowercase else "toks")
    if cfg.lemmatize and cfg.nlp_backend == "spacy":
        return F.transform("model_lemmas", F.lower) if cfg.lowercase else F.col("model_lemmas")
    if cfg.lemmatize:
        return F.transform(words, lambda w, i: F.when(F.substr(cls, i + 1, F.lit(1)).isin("A", "N"), lemma(w)).otherwise(w))
    return words


def _worded(s: Column) -> Column:
    words = lambda c: F.array_join(F.slice(F.col(c), s["st"], F.length(s["core"])), " ")
    return F.struct(s["so"].alias("so"), s["tag"].alias("tag"), s["i"].alias("i"), s["core"].alias("core"), words("toks").alias("surface"), words("norm").alias("cand"))


def kept_spans(df: DataFrame, cfg: ExtractConfig = ExtractConfig(), blacklist: DataFrame | None = None) -> DataFrame:
    """Spans that survive trimming and filters, one row each, with surface and normalised form.

    Empty results and forms in ``blacklist`` (column ``candidate``, exact match) are dropped. The blacklist is a hand-kept
    file; Spark broadcasts it while it is below the broadcast threshold and shuffles otherwise.
    """
    rows = tokens(df, cfg).withColumn("norm", _norm_tokens(cfg))
    good = F.filter(_trimmed(_all_spans(cfg)), lambda s: _passes(s["core"], cfg))
    flat = rows.select("row_id", "section_ord", "source_section", F.explode(F.transform(good, _worded)).alias("s"))
    out = flat.select(
        "row_id", "section_ord", "source_section", F.col("s.so").alias("source_ord"), F.col("s.tag").alias("source"),
        F.col("s.i").alias("span_ord"), F.col("s.surface").alias("surface_form"), F.col("s.cand").alias("candidate"),
    ).filter("candidate <> ''")
    return out.join(blacklist.select("candidate").distinct(), "candidate", "left_anti") if blacklist is not None else out


def extract(df: DataFrame, cfg: ExtractConfig = ExtractConfig(), blacklist: DataFrame | None = None) -> DataFrame:
    """Occurrences ``row_id, candidate, surface_form, source_section, extraction_source`` with order columns.

    One row per document, section and normalised form: the surface of its first span, the sorted tags of all its
    sources joined by ``|``, and ``n_spans``, its spans in the section (1 without ``keep_duplicates``). ``source_ord`` and ``span_ord`` are those of the first span. A document
    without text gives no row; an empty table gives an empty table of the same columns.
    """
    order = F.struct("source_ord", "span_ord")
    merged = kept_spans(df, cfg, blacklist).groupBy("row_id", "section_ord", "source_section", "candidate").agg(
        F.min(F.struct("source_ord", "span_ord", "surface_form")).alias("_f"),
        F.array_join(F.array_sort(F.collect_set("source")), "|").alias("extraction_source"),
        (F.count(order) if cfg.keep_duplicates else F.lit(1).cast("bigint")).alias("n_spans"),
    )
    return merged.select("row_id", "candidate", F.col("_f.surface_form").alias("surface_form"), "source_section", "extraction_source", "section_ord", F.col("_f.source_ord").alias("source_ord"), F.col("_f.span_ord").alias("span_ord"), "n_spans")


def explain_spans(df: DataFrame, cfg: ExtractConfig = ExtractConfig(), blacklist: DataFrame | None = None) -> DataFrame:
    """Every raw span with its ``outcome``: KEPT, DUPLICATE or the reason why it was dropped.

    Reasons in order: empty after trimming, length, no noun, punctuation, numeric, a stop word at the start or the end,
    empty after normalisation, blacklisted. A span is a duplicate if an earlier one of its section has the same normalised form.
    """
    rows = tokens(df, cfg).withColumn("norm", _norm_tokens(cfg))
    flat = rows.select("row_id", "section_ord", "source_section", F.explode(F.transform(_trimmed(_all_spans(cfg)), _worded)).alias("s"))
    out = flat.select("row_id", "section_ord", "source_section", F.col("s.so").alias("source_ord"), F.col("s.tag").alias("source"), F.col("s.i").alias("span_ord"), F.col("s.core").alias("core"), F.col("s.cand").alias("candidate"))
    black = F.lit(False)
    if blacklist is not None:
        out = out.join(blacklist.select("candidate", F.lit(True).alias("_b")).distinct(), "candidate", "left")
        black = F.coalesce(F.col("_b"), F.lit(False))
    core = F.col("core")
    dropped = (
        F.when(core == "", "DROPPED: empty after trim")
        .when(~F.length(core).between(cfg.min_candidate_length, cfg.max_candidate_length), "DROPPED: length")
        .when(F.instr(core, "N") == 0, "DROPPED: no noun")
        .when(F.instr(core, "P") > 0, "DROPPED: punctuation")
        .when(core.rlike("^D+$"), "DROPPED: numeric")
        .when(core.startswith("S"), "DROPPED: starts with a stop word")  # only if a source's spans are not trimmed
        .when(core.endswith("S"), "DROPPED: ends with a stop word")
        .when(F.col("candidate") == "", "DROPPED: empty after normalise")
        .when(black, "DROPPED: blacklisted")
    )
    from pyspark.sql import Window

    w = Window.partitionBy("row_id", "section_ord", "candidate", F.col("_d").isNull()).orderBy("source_ord", "span_ord")
    seen = out.withColumn("_d", dropped).withColumn("_n", F.row_number().over(w))
    outcome = F.coalesce(F.col("_d"), F.when(F.col("_n") > 1, "DUPLICATE").otherwise("KEPT"))
    return seen.select("row_id", "source_section", "source", "span_ord", "candidate", outcome.alias("outcome"))
