"""Exact merges, round trips and odd rows."""

from __future__ import annotations

import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from driverlens.llm import bpe
from fixtures import ROWS, frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    tokens = bpe.read_ranks(PATH)
    return bpe.Encoder(tokens, bpe.merge_halves(tokens), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def expected():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=200) | st.text("therinon aXé", max_size=200))
def test_ids_are_those_of_the_merges(encoder, expected, text):
    ids = encoder.encode(text)
    assert ids == expected.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_long_pieces_and_texts(encoder, expected):
    for text in ("ab" * 20_000, " " * 5_000 + "x", "naïve " * 40_000):
        assert encoder.encode(text) == expected.encode_ordinary(text)


def test_table(spark, expected):
    out = bpe.encode(frame(spark), PATH, public_tokenizers.PATTERN, decoded="decoded").collect()
    assert len(out) == len(ROWS)
    for row in out:
        assert row.ids == expected.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
        assert row.score == 0.25  # other columns pass through; "ids" is replaced
    again = bpe.decode(spark.createDataFrame([([],), (None,), ([50, 51],)], "ids ARRAY<INT>"), PATH).collect()
    assert [bytes(r.decoded) for r in again][:2] == [b"", b""]


def test_empty_table(spark):
    assert bpe.encode(frame(spark, []), PATH, public_tokenizers.PATTERN).collect() == []
