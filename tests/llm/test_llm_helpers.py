"""Hashes, permutation, entropy coding and cached encoding against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starweir.llm import rans
from starweir.llm.sharding import permute
from starweir.llm.text import (
    WORD_BASES,
    chunks,
    utf8,
    window_hashes,
    window_minima,
    words_of,
)
from starweir.llm.tokens import encoder

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_runs_without_ascii_blanks(texts):
    data, bounds = utf8(pa.array(texts, pa.string()))
    words = words_of(data, bounds)
    expected = [(t or "").encode().split() for t in texts]
    flat = [w for own in expected for w in own]
    assert [bytes(data[s:e]) for s, e in zip(words.starts, words.ends)] == flat
    assert list(np.diff(words.first)) == [len(own) for own in expected]
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))
    assert {(w, int(h)) for w, h in zip(flat, hashes)}.__len__() == len(set(flat))


@pytest.mark.parametrize("length", [1, 2, 3, 5, 20, 50])
def test_windows(length):
    items = np.random.default_rng(length).integers(0, 9, 70).astype(np.uint64)
    base = int(WORD_BASES[0])
    rolled = []
    for i in range(len(items) - length + 1):
        value = 0
        for item in items[i : i + length]:
            value = (value * base + int(item)) % 2**64
        rolled.append(value)
    assert window_hashes(items, length, WORD_BASES[0]).tolist() == rolled
    least = [i + int(np.argmin(items[i : i + length])) for i in range(len(rolled))]
    assert window_minima(items, length).tolist() == least
    assert len(window_hashes(items, 71, WORD_BASES[0])) == len(window_minima(items, 71)) == 0


def test_chunks_cover_all_rows_and_take_a_long_one_alone():
    bounds = np.array([0, 5, 5, 2000, 2001, 2010])
    ranges = list(chunks(bounds, 10))
    assert [r for a, b in ranges for r in range(a, b)] == list(range(5))
    assert (2, 3) in ranges
    assert list(chunks(np.array([0]))) == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    places = permute(np.arange(n), n, seed=3)
    assert sorted(places) == list(range(n))
    assert (places == permute(np.arange(n), n, seed=3)).all()
    assert n < 100 or (places != permute(np.arange(n), n, seed=4)).any()


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 65536, 65537, 200_001])
def test_entropy_coding_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 49408).astype(np.uint32)
    symbols, frequencies = rans.frequency_table(ids)
    assert n == 0 or frequencies.sum() == 1 << rans.SCALE_BITS
    blocks = rans.encode(ids, symbols, frequencies)
    assert (rans.decode(blocks, symbols, frequencies) == ids).all()


def test_entropy_coding_notices_damage_and_is_short():
    ids = (np.random.default_rng(1).zipf(1.5, 300_000) % 5000).astype(np.uint32)
    symbols, frequencies = rans.frequency_table(ids)
    blocks = rans.encode(ids, symbols, frequencies)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    bits = 8 * sum(len(b.words) + len(b.states) for b in blocks)
    assert bits < 1.1 * len(ids) * -(share * np.log2(share)).sum()
    broken = bytearray(blocks[0].words)
    broken[100] ^= 1
    blocks[0].words = bytes(broken)
    with pytest.raises(ValueError):
        rans.decode(blocks, symbols, frequencies)


ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a \nb", "a\n \nb", "x.\nYy z", "\n\n a", None,
    "don't we'll it's 'S", "İstanbul ΣΑΣ", "é x́y", " ́a", "<|endoftext|> a <|endoftext|>b",
    "<|ENDOFTEXT|>", "a\xa0b  c", "a\tb", "12 345abc", "x### y!!", "\u3000a b", "ab.\n cd",
    "a'\nb", "q \x1cz", "中文 字。", "👍🏽 hi", "¿qué «a»", "w" * 3000,
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoding_equals_whole_encoding(name):
    rng = random.Random(3)
    made = ["".join(rng.choice("ab .\n\t'sé1#́Z") for _ in range(rng.randrange(30))) for _ in range(1500)]
    cached = encoder(name)
    for texts in (ODD + made, ODD, [], [None]):
        ids, bounds = cached.encode(pa.array(texts, pa.string()))
        whole = cached.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in whole]
