import hashlib
import json
import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vibralake.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    path = bpe.default_vocabulary()
    with open(path, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read()), tokenizers.Tokenizer.from_file(path)


def library(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(["<|endoftext|>", " the", "'ll", "\x85", "　", "ing", "日本語", "0123", "é"])), max_size=8).map("".join))
@settings(max_examples=300, deadline=None)
def test_equals_the_library(both, text):
    vocabulary, tokenizer = both
    ids = vocabulary.encode_batch([text])[0]
    assert ids == library(tokenizer, text)
    assert vocabulary.decode(ids) == text


def test_random_strings_of_all_planes(both):
    """Pairs and triples of code points that Unicode versions class differently, with others around them."""
    vocabulary, tokenizer = both
    for text in ("\U0003d476\u6049", "\U00018f48\u8667", "\U0003ea76\u60a3"):
        assert vocabulary.encode_batch([text])[0] == library(tokenizer, text)
    rng = random.Random(11)
    spans = [(0x20, 0x7F), (0x09, 0x0E), (0x80, 0x500), (0x500, 0x3000), (0x3000, 0xA000), (0xA000, 0xD800), (0xE000, 0x10000), (0x10000, 0x20000), (0x20000, 0x34000), (0x34000, 0x110000)]
    edges = [0x558, 0x58B, 0x88F, 0x1C89, 0xA7CB, 0xA7CE, 0x105C0, 0x10D40, 0x11DE0, 0x13460, 0x16D70, 0x18CFF, 0x187F8, 0x2B73A, 0x323B0, 0x85, 0xA0, 0x1680, 0x180E, 0x200B, 0x2028, 0x3000, 0xFEFF, 0x1C]
    texts = ["".join(chr(rng.choice(edges) if rng.random() < 0.1 else rng.randrange(*rng.choice(spans))) for _ in range(rng.randrange(1, 7))) for _ in range(40_000)]
    found = vocabulary.encode_batch(texts)
    wanted = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, found, wanted, strict=True) if a != b] == []
    assert [vocabulary.decode(x) for x in found] == texts


def test_classes_equal_the_library():
    """The splitter's own split of code points behind a letter, a number and a sign: all where a class begins or ends, and others."""
    splitter = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    kind = [None if 0xD800 <= c < 0xE000 else (unicodedata.category(chr(c)), len(bpe.split_words("a" + chr(c)))) for c in range(0x110000)]
    picked = random.Random(3).sample(range(0x110000), 30_000) + [c for c in range(1, 0x110000) if kind[c] != kind[c - 1] for c in (c - 1, c)]
    every = [chr(c) for c in sorted(set(picked)) if kind[c]]
    for i in range(0, len(every), 1 << 9):
        text = "".join(f"{lead}{c}\n" for c in every[i : i + (1 << 9)] for lead in "a1!")
        ends = np.cumsum([len(w) for w in bpe.split_words(text)]).tolist()
        assert ends == [end for _, (_, end) in splitter.pre_tokenize_str(text)]


def test_flags_of_added_tokens_and_other_settings(both):
    with open(bpe.default_vocabulary(), encoding="utf-8") as file:
        content = json.load(file)
    content["added_tokens"] += [
        {"id": 50257, "content": "<mask>", "single_word": False, "lstrip": True, "rstrip": False, "normalized": False, "special": True},
        {"id": 50258, "content": "<end>", "single_word": False, "lstrip": False, "rstrip": True, "normalized": False, "special": True},
        {"id": 50259, "content": "zqword", "single_word": True, "lstrip": False, "rstrip": False, "normalized": False, "special": True},
    ]
    vocabulary, tokenizer = bpe.Vocabulary(json.dumps(content)), tokenizers.Tokenizer.from_str(json.dumps(content))
    for text in ("a  <mask> b", "a <end>  \n b<end>", "zqword szqword zqword, zqwords", "<mask><end><mask>", " <mask>\n <|endoftext|> <mask> "):
        assert vocabulary.encode_batch([text])[0] == library(tokenizer, text), text
    content["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError, match="add_prefix_space"):
        bpe.Vocabulary(json.dumps(content))


def test_a_very_long_text(both):
    vocabulary, tokenizer = both
    text = ("Lorem ipsum dolor sit amet, 1234 consectetur \u65e5\u672c\n" * 60_000) + "x" * 50_000  # 3 MB
    ids = vocabulary.encode_batch([text])[0]
    assert ids == library(tokenizer, text) and vocabulary.decode(ids) == text


def test_long_words_and_full_caches(both, monkeypatch):
    vocabulary, tokenizer = both
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 10)
    texts = ["x" * 3000, "ab" * 900, " " * 500, "counterrevolutionaries unbelievable", ""] * 2
    assert vocabulary.encode_batch(texts) == [library(tokenizer, t) for t in texts]


def test_documents(docs, rows, empty, both):
    _, tokenizer = both
    found = sorted(map(tuple, bpe.digest(docs).collect()), key=str)
    wanted = []
    for r in rows:
        ids = library(tokenizer, r[1] or "")
        wanted.append((r[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert found == sorted(wanted, key=str)
    assert bpe.digest(empty).count() == 0
    assert bpe.encode_documents(docs, columns=("doc_id", "key_a")).columns == ["doc_id", "key_a", "ids", "decoded"]
