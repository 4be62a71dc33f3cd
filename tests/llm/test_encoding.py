import base64

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from phrasemill.llm.encoding import decode_ids, encode_texts, encoder

VOCABULARY = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "The lithium-ion cell's anode, 3.5 V!", "   leading and trailing   ", "tabs\t\tand\r\n\r\nlines\n", "Zelle für größere Verluste", "電池のセル。リチウム", "Ячейка с материалом", "a" * 5000, "ab" * 3000,
    "<|endoftext|> as text", "don't they'll I'd", "​﻿ zero", "🔋⚡", "x = y**2 + z_0; // loss\n\n\n\n    return x", " ", "\n", "0" * 999, "é", "é", "aaaaab" * 50, "!" * 300, "\x00\x01",
]


@pytest.fixture(scope="module")
def enc():
    return encoder(open(VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def other():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_both_libraries(enc, other):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for x in TEXTS:
        assert enc.encode(x) == other.encode_ordinary(x) == t.encode(x, add_special_tokens=False).ids


def test_pieces_equal_merging_by_definition(enc):
    for x in TEXTS:
        for piece in enc.split(x):
            if len(piece) < 200:
                assert enc.encode_piece(piece.encode()) == enc.merge(piece.encode())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abcde ", max_size=200), st.text(alphabet="thein gr", max_size=200)))
def test_random_texts(enc, other, x):
    ids = enc.encode(x)
    assert ids == other.encode_ordinary(x)
    assert enc.decode(ids) == x


def test_tables(spark):
    rows = [(i, x, i) for i, x in enumerate(TEXTS)] + [(100, None, 0), (101, "", 0), (None, "cell", 0)]
    df = spark.createDataFrame(rows, "k BIGINT, t STRING, ids BIGINT")
    out = encode_texts(df, "k", "t", VOCABULARY)
    got = {r.k: r.ids for r in out.collect()}
    assert got[100] == got[101] == [] and got[None] == [3846] and len(got) == len(rows)
    back = {r.k: r.text for r in decode_ids(out, "k", "ids", VOCABULARY).collect()}
    assert all(back[k] == (t or "") for k, t, _ in rows)
    assert encode_texts(df.limit(0), "k", "t", VOCABULARY).collect() == []
