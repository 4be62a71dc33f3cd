import pickle
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from phrasemill.llm import leakage

ITEM = "Suppose seven coated cells share one sealed valve; after winding each loses 30.5 kPa because ion transport dominates."


def seq(text):
    return [w for w, _, _ in leakage.words(text, {})]


def brute(doc, item, least=6):
    """Item words covered by common runs of ``least`` words, by all positions."""
    grams = {tuple(doc[i : i + least]) for i in range(len(doc) - least + 1)}
    hit = set()
    for i in range(len(item) - least + 1):
        if tuple(item[i : i + least]) in grams:
            hit |= set(range(i, i + least))
    return len(hit)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
def test_coverage_equals_brute_force(items, doc):
    automaton = leakage.SuffixAutomaton(enumerate(items), 3)
    got = {i: m.bit_count() for i, (m, _, _) in automaton.covered(doc).items()}
    assert got == {i: n for i, x in enumerate(items) if (n := brute(doc, x, 3))}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=12), min_size=1, max_size=5), st.lists(st.sampled_from("abc"), max_size=30))
def test_runs_and_spans_equal_brute_force(items, doc):
    """The longest common run and the document's words inside common runs, also after a round trip through bytes."""
    automaton = pickle.loads(pickle.dumps(leakage.SuffixAutomaton(enumerate(items), 2)))
    got = automaton.covered(doc)
    for i, x in enumerate(items):
        runs = [(p, n) for n in range(2, len(x) + 1) for p in range(len(doc) - n + 1) if any(doc[p : p + n] == x[q : q + n] for q in range(len(x) - n + 1))]
        assert (i in got) == bool(runs)
        if runs:
            assert got[i][1] == max(n for _, n in runs)
            assert {k for a, b in got[i][2] for k in range(a, b)} == {k for p, n in runs for k in range(p, p + n)}


def test_a_passage_of_many_items_is_reported_once():
    shared = [f"w{i}" for i in range(200)]
    automaton = leakage.SuffixAutomaton([(i, [f"a{i}", *shared, f"b{i}"]) for i in range(300)], 6)
    reports = []
    plain = automaton._report
    automaton._report = lambda *a: (reports.append(a[1:]), plain(*a))
    got = automaton.covered(["x", *shared, "y"])
    assert len(got) == 300 and all(m.bit_count() == 200 and n == 200 and s == [(1, 201)] for m, n, s in got.values()) and len(reports) == 1


def test_size_of_an_automaton_is_linear_in_the_words():
    rng = random.Random(1)
    items = [(i, [f"w{rng.randrange(5000)}" for _ in range(50)]) for i in range(1000)]
    items += [(5000 + i, items[0][1]) for i in range(200)]  # copies add no states, only places
    automaton = leakage.SuffixAutomaton(items)
    assert automaton.nbytes() < 100 * sum(len(x) for _, x in items)


def test_words_ignore_case_punctuation_and_disguises():
    assert seq("Ｓuppоse—ｓeven\n co​ated, CELLS") == ["suppose", "seven", "coated", "cells"]
    assert seq("café café") == ["café", "café"]
    assert seq("­ ​ ...") == []


def tables(spark, docs, items):
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id BIGINT, text STRING, item_id STRING"), spark.createDataFrame([(*i, 1) for i in items], "item_id BIGINT, item_text STRING, doc_id BIGINT")


def test_found(spark):
    w = ITEM.split()
    half = " ".join(w[3:14])
    docs = [
        (1, "Intro. " + ITEM.upper() + " More."), (2, "x " + half + " y"), (3, " ".join(w[:5]) + " q " + " ".join(w[6:11]) + " q " + " ".join(w[12:])), (4, None), (5, ""), (6, "  "),
        (7, ITEM.replace("a", "а").replace(" ", " ")), (8, " ".join(w[2:9])), (9, "word " * 50_000 + ITEM),
    ]
    items = [(70, ITEM), (71, ITEM.lower().replace(";", "")), (72, "Name the sealed valve."), (73, None), (74, " "), (75, "one two three four five six seven eight nine ten eleven")]
    d, i = tables(spark, docs + [(10, items[-1][1])], items)
    got = sorted(tuple(r) for r in leakage.leaked_items(d, i).collect())
    assert got == [(k, j) for k in (1, 2, 7, 9) for j in (70, 71)]
    assert leakage.leaked_items(d, i.limit(0)).collect() == [] and leakage.leaked_items(d.limit(0), i).collect() == []


def test_item_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(20))) for i in range(12)]
    docs = [(i, " ".join([*(rng.choice(vocabulary) for _ in range(10)), *rng.choice(items)[1].split()[2:16]])) for i in range(20)]
    d, i = tables(spark, docs, items)
    whole = sorted(tuple(r) for r in leakage.find_leaks(d, i).collect())
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 50)
    assert sorted(tuple(r) for r in leakage.find_leaks(d, i).collect()) == whole
    monkeypatch.setattr(leakage, "PASS_BYTES", 6000)
    assert sorted(tuple(r) for r in leakage.find_leaks(d, i).collect()) == whole
    want = {(k, j, n) for k, t in docs for j, x in items if (n := brute(t.split(), x.split()))}
    assert {r[:3] for r in whole} == want


def test_spans_are_cut_out(spark):
    d, i = tables(spark, [(1, f"Start here. {ITEM} The end."), (2, "nothing at all"), (3, None)], [(70, ITEM)])
    (r,) = leakage.remove_leaks(d, i).collect()
    assert r.text == "Start here. . The end." and r.n_removed == len(seq(ITEM))
