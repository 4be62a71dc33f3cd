"""Rule tokenizer, word classes and the S-stemmer, as JVM expressions.

Each token gets one class letter: P punctuation, D number, S stop or closed-class word, A adjective, V verb or other,
N noun. The letters of a section form a string as long as its token array, on which spans are cut and tested with
plain string functions. Unknown words count as nouns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our own closed-class list: articles, pronouns, prepositions, conjunctions, auxiliaries, particles.
STOP_WORDS = tuple(
    "a an the this that these those each every any some no such said other another all both either neither same "
    "i you he she it we they them its their his her our your itself themselves which who whom whose what "
    "of in on at by for from to with without within into onto over under between among through during after before "
    "above below against along across around about than as per via upon toward towards near off out up down "
    "and or but nor so yet if while whereas because since although though when where whether until unless once "
    "is are was were be been being am has have had do does did can could may might must shall should will would "
    "not only also too very more most less least further then thus hence therefore wherein whereby thereof therein "
    "thereto thereby here there again just well how why".split()
)
NUMBER_WORDS = tuple("zero one two three four five six seven eight nine ten eleven twelve hundred thousand million half".split())
VERBS = tuple(
    "comprises comprising comprise includes including include provides providing provided provide uses using used use "
    "makes making made make placed places held holds hold rests rest lies lie leaves leave gives gave give depends "
    "disclosed discloses releases release reduces reduce absorbs absorb prevents prevent improves improve fixed delays "
    "encloses ends exceeds separated compared loses shown based having according".split()
)
ADJECTIVE_ENDING = "(al|ic|ive|ous|able|ible|ary|ful|less|ular|ed)$"
VERB_ENDING = "(izes|ises|ifies|ates|ly)$"
TOKEN = r"\p{L}+|[0-9]+|[^\p{L}0-9\s]"
TOKEN_KEEPING_HYPHENS = r"\p{L}+(?:-\p{L}+)*|[0-9]+|[^\p{L}0-9\s]"


def tokenize(text: Column, hyphen: str = "split") -> Column:
    """Words, digit runs and single other characters, in order; ``hyphen='keep'`` leaves hyphenated words whole."""
    if hyphen not in ("split", "keep"):
        raise ValueError(f"hyphen must be 'split' or 'keep', not {hyphen!r}")
    return F.regexp_extract_all(text, F.lit(TOKEN if hyphen == "split" else TOKEN_KEEPING_HYPHENS), F.lit(0))


def _ends_with(low: Column, ending: str) -> Column:
    """Whether a word ends in one of the alternatives of ``(x|y)$``; set look-ups on its tail, no regular expression."""
    by_length: dict[int, list[str]] = {}
    for e in ending.strip("()$").split("|"):
        by_length.setdefault(len(e), []).append(e)
    tests = [F.substring(low, -n, n).isin(*es) for n, es in sorted(by_length.items())]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def word_class(low: Column) -> Column:
    """Class letter of one lower-case token. A token that starts with a Latin letter is tested without patterns."""
    other = ~((low >= "a") & (low < "{"))
    long = F.length(low) > 4
    return (
        F.when(other & low.rlike(r"^[^\p{L}0-9]"), "P")
        .when((other & low.rlike("^[0-9]")) | low.isin(*NUMBER_WORDS), "D")
        .when(low.isin(*STOP_WORDS), "S")
        .when(low.isin(*VERBS) | (long & _ends_with(low, VERB_ENDING)), "V")
        .when(long & _ends_with(low, ADJECTIVE_ENDING), "A")
        .otherwise("N")
    )


def class_string(low: Column) -> Column:
    """One class letter per lower-case token, joined."""
    return F.array_join(F.transform(low, word_class), "")


def lemma(w: Column) -> Column:
    """S-stemmer (Harman 1991): ``ies`` to ``y``, ``es`` to ``e``, ``s`` dropped, with its exceptions; first rule wins."""
    low = F.lower(w)
    return (
        F.when(low.rlike("[^ea]ies$"), F.regexp_replace(low, "ies$", "y"))
        .when(low.rlike("[^aeo]es$"), F.regexp_replace(low, "es$", "e"))
        .when(low.rlike("[^us]s$"), F.regexp_replace(low, "s$", ""))
        .otherwise(low)
    )


def lemma_key(text: Column) -> Column:
    """Lower-case lemmas of all tokens of a phrase, joined by spaces; null gives ''."""
    return F.array_join(F.transform(tokenize(F.coalesce(text, F.lit(""))), lemma), " ")
