"""Ids by words against the library, on odd words and on files with other rules."""

import json
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from vellumgrid.llm import word_ids

WORDS = ["the", "Straße", "École", "I'm", "don't", "'s", "''s", "x1y22", "a.b.c", "!!!", "<|endoftext|>", "<|EndOfText|>", "<|", "日本語", "İx", "ΣΑΣ",
    "é", "á̧", "ÿÝ", "×÷", "ÆØ", "\x1c", "\x85", " ", "\xa0", "\x7f", "\x00", "😀", "aaaa", "aaaaaaa", "ﬁ", "ǅ", "​", "１２", "½", "ªº", "_", "$$$",
    "0123456789"]
LETTERS = "abcdeABCDE étÀß'.,!-<|>019 \t\n\v\f\r\x1c\x85 日İ"


@pytest.fixture(scope="module")
def own():
    return word_ids.ids_at(public_tokenizers.path("word_bpe_49k.json"))


def _texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    part = lambda: r.choice(WORDS) if r.random() < 0.5 else "".join(r.choice(LETTERS) for _ in range(r.randrange(12)))
    return [r.choice(["", " ", "\n"]).join(part() for _ in range(r.randrange(8))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_ids_are_those_of_the_library(own, seed):
    assert own.merges is not None
    texts = _texts(seed, 1500)
    ids, to = own.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(to, to[1:])] == own.encode_library(texts)


def test_long_texts_are_cut_at_white_space(own, monkeypatch):
    texts = ["", *_texts(9, 300), " ".join(_texts(10, 200)), "x" * 900, " \n" * 400]
    monkeypatch.setattr(word_ids, "CHUNK", 64)
    ids, to = own.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(to, to[1:])] == own.encode_library(texts)
    assert own.encode(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_other_rules_go_through_the_library(tmp_path, change):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        rules = json.load(f)
    (tmp_path / "other.json").write_text(json.dumps(rules | change))
    other = word_ids.WordIds(str(tmp_path / "other.json"))
    assert other.merges is None
    texts = _texts(3, 200)
    ids, to = other.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(to, to[1:])] == other.encode_library(texts)


def test_merges_out_of_order_are_refused():
    vocab = {c: i for i, c in enumerate(dict.fromkeys([*word_ids._visible().values(), *(x + "</w>" for x in word_ids._visible().values()), "ab", "abc"]))}
    with pytest.raises(ValueError):
        word_ids.Merges(vocab, ["ab c", "a b"])
    assert np.array_equal(word_ids.Merges(vocab, ["a b", "ab c"]).apply(np.frombuffer(b"abcabd", np.uint8), np.array([1, 0, 0, 0, 0, 0], bool))[:2], [vocab["abc"], -1])
