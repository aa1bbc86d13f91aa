import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripartite.llm.bpe import byte_bpe, encoder
from tripartite.llm.bytewords import Slots, buffers, hashes, words
from tripartite.llm.shingles import common, least_difference, parity, shingle_sets

ODD = st.text(alphabet=" \n\tab.,'é s1<  　\x1cZ", max_size=20)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=6))
def test_encoder_gives_the_vocabularys_ids(texts):
    ids, at = encoder()(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == byte_bpe().encode_ordinary(text)


def test_rank_file_and_tokenizer_file_agree():
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = ["".join(rng.choice("the qu é日, .\n3'sAB") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    for text in texts:
        assert byte_bpe().encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ADDED = st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", "it's", "日", "\u3000", "."]), max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(ADDED.map("".join), max_size=4))
def test_added_tokens_have_the_tokenizer_files_ids(reference, texts):
    texts = ["a <|endoftext|> b", *texts]
    ids, at = encoder()(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        want = reference.encode(text, add_special_tokens=False).ids
        assert ids[at[k] : at[k + 1]].tolist() == byte_bpe().encode_ordinary(text) == want
    assert ids[: at[1]].tolist() == [64, 220, 50256, 275]


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=6))
def test_words_and_hashes(texts):
    data, offsets = buffers(pa.array(["skipped", *texts], pa.string()).slice(1))
    starts, ends = words(data, offsets)
    got = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert got == [w for t in texts for w in t.encode().split()]
    h = hashes(data, starts, ends)
    assert len(set(zip([w.lower() for w in got], h.tolist(), strict=True))) == len({w.lower() for w in got})


def test_hash_of_a_word_does_not_depend_on_its_place():
    text = (b"word " * 300_000) + b"w" * 3_000_000 + b" word"
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    h = hashes(data, *words(data, offsets))
    assert len(set(h[:300_000].tolist())) == 1 and h[0] == h[-1] != h[-2]


def test_slots_forget_but_never_mix_up():
    known = Slots(2, 1, np.int64)
    rng = np.random.default_rng(1)
    for _ in range(50):
        h = rng.integers(1, 40, 30).astype(np.uint64) << np.uint64(58)
        assert known.look(h, lambda new, h=h: (h[new] >> np.uint64(58)).astype(np.int64)[:, None])[:, 0].tolist() == (
            h >> np.uint64(58)
        ).tolist()


def brute_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def test_shingles_and_their_bounds():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdeF") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    sets, wanted = shingle_sets(pa.array(texts)), [brute_set(t) for t in texts]
    for a, x in zip(sets, wanted, strict=True):
        assert len(a) == len(x)
        for b, y in zip(sets, wanted, strict=True):
            assert common(a, b) == len(x & y)
            assert least_difference(parity(a), parity(b)) <= len(x ^ y)
    big = [np.unique(np.random.default_rng(k).integers(0, 1 << 62, n)).astype(np.uint64) for k, n in ((1, 40), (2, 5000))]
    assert least_difference(parity(big[0]), parity(big[1])) <= 5040
