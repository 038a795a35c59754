"""Byte-level BPE by traversal of a trie of distinct words.

A prefix of a word has an encoding of its own, and that encoding ends in exactly one token: the
only vocabulary entry that is a suffix of the prefix and compatible with the last token of what
stands before it (two tokens are compatible if encoding their joined bytes gives the two back).
So the distinct words of a batch go into a trie, and a depth-first walk hands the last tokens down:
whatever prefix words share is encoded once, and a word's tokens are read backwards from its end.

The trie isn't built of nodes: its depth-first order is that of the sorted words. The words'
encodings are kept between batches up to a bound.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import CHUNK_BYTES, chunks, clean_columns, ship

#: Words and pairs of tokens that a worker keeps, and the length from which a word is not kept.
KEPT_WORDS, KEPT_PAIRS, LONG_WORD = 300_000, 300_000, 48
#: How the file's ByteLevel splitter cuts text before merging, with the classes of Unicode
#: 16.0, the version of the library's splitter: the letters and numbers that Unicode 15.1 doesn't have,
#: and the white space. Versions of the classes differ in what lies from U+0500 on.
LETTERS_16 = (
    "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e 11390-113b5 113b7 113d1 113d3 "
    "11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0"
)
NUMBERS_16 = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
_FAST = regex.compile(PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=SPACE))
_FAR = re.compile("[\u0500-\U0010ffff]")


def _ranges(points: set[int]) -> str:
    """A character class, without its brackets."""
    runs: list[list[int]] = []
    for c in sorted(points):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


@cache
def _exact() -> tuple[re.Pattern, re.Pattern]:
    """The splitter with its classes spelled out, and what the fast splitter (another Unicode version) classes otherwise."""
    wrong: set[int] = set()
    own: dict[str, set[int]] = {"L": set(), "N": set()}
    for kind, fixed in (("L", LETTERS_16), ("N", NUMBERS_16)):
        for first, _, last in (part.partition("-") for part in fixed.split()):
            own[kind].update(range(int(first, 16), int(last or first, 16) + 1))
    for start in range(0, sys.maxunicode + 1, 4096):
        if 0xD800 <= start < 0xE000:
            continue
        points = range(start, start + 4096)
        text = "".join(map(chr, points))
        for kind, found in own.items():
            found.update(c for c in points if unicodedata.category(chr(c))[0] == kind)
            wrong |= found.intersection(points) ^ set(map(ord, regex.findall(rf"\p{{{kind}}}", text)))
    classes = {kind: _ranges(found) for kind, found in own.items()}
    return re.compile(PATTERN.format(S=SPACE, **classes)), re.compile(f"[{_ranges(wrong)}]" if wrong else r"(?!)")


def split_words(text: str) -> list[str]:
    """The words that a text without added tokens is merged by."""
    if _FAR.search(text):
        exact, differs = _exact()
        if differs.search(text):
            return exact.findall(text)
    return _FAST.findall(text)


def _added_pattern(tokens: list[dict]) -> regex.Pattern | None:
    """Matches of added tokens, longest first of those that begin at a place, with the flags of the file."""
    made = []
    for token in sorted(tokens, key=lambda t: len(t["content"]), reverse=True):
        body = regex.escape(token["content"])
        if token.get("single_word"):
            body = rf"(?<!\w){body}(?!\w)"
        made.append((r"\s*" if token.get("lstrip") else "") + body + (r"\s*" if token.get("rstrip") else ""))
    return regex.compile("(" + "|".join(made) + ")") if made else None


def default_vocabulary() -> str:
    """Where the box has its byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and added tokens of a tokenizer file, with encoder and decoder."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        wanted = {"model.type": "BPE", "pre_tokenizer.type": "ByteLevel", "pre_tokenizer.use_regex": True, "pre_tokenizer.add_prefix_space": False, "decoder.type": "ByteLevel"}
        off = ("normalizer", "model.dropout", "model.unk_token", "model.continuing_subword_prefix", "model.end_of_word_suffix", "model.byte_fallback", "model.ignore_merges")
        for name, value in [*wanted.items(), *((n, None) for n in off)]:
            at = file
            for part in name.split("."):
                at = (at or {}).get(part)
            if (at or None) != (value or None):
                raise ValueError(f"a tokenizer with {name} = {at!r} is not supported")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(t): i for t, i in file["model"]["vocab"].items()}
        self.ranks = {(raw(a), raw(b)): k for k, (a, b) in enumerate(file["model"]["merges"])}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.longest = max(map(len, self.ids))
        self.split_added = _added_pattern(file["added_tokens"])
        self.tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self._fits: dict[int, bool] = {}
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merged(self, word: bytes) -> list[bytes]:
        """The definition of the encoding: merge the pair of lowest rank, leftmost first, until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the tokens may stand side by side."""
        known = self._fits.get(left + 1 << 32 | right)
        if known is None:
            if len(self._fits) > KEPT_PAIRS:
                self._fits.clear()
            a, b = self.tokens[left], self.tokens[right]
            known = self._fits[left + 1 << 32 | right] = (a, b) not in self.ranks and self.merged(a + b) == [a, b]
        return known

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Encodings of distinct words, as little-endian 32-bit integers.

        In sorted order, the words are the trie in depth-first order: the path that a word shares
        with the one before it stays, with the last tokens of all prefixes on it, and only the rest
        is walked. At a word's end its tokens are read backwards along the path.
        """
        made: dict[str, bytes] = {}
        find, longest, fits, known = self.ids.get, self.longest, self.fits, self._fits.get
        path = b""
        last, width = [0], [0]  # of the prefix of each length: its last token, and that token's length
        for word, text in sorted((w.encode(), w) for w in words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], width[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(end - longest, 0), end):
                    token = find(word[start:end])
                    if token is None:
                        continue
                    if start:
                        fit = known(last[start] + 1 << 32 | token)
                        if fit is None:
                            fit = fits(last[start], token)
                    else:
                        fit = self.whole(token)
                    if fit:
                        last.append(token)
                        width.append(end - start)
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            path, end, out = word, len(word), []
            while end:
                out.append(last[end])
                end -= width[end]
            out.reverse()
            made[text] = struct.pack(f"<{len(out)}I", *out)
        return made

    def whole(self, token: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        known = self._fits.get(token)
        if known is None:
            known = self._fits[token] = self.merged(self.tokens[token]) == [self.tokens[token]]
        return known

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Encodings of whole texts; strings of added tokens become these."""
        split: list[list[str]] = []
        for text in texts:
            words: list[str] = []
            for i, piece in enumerate(self.split_added.split(text) if self.split_added else [text]):
                words.extend([piece if piece in self.added else piece.strip()] if i % 2 else split_words(piece))
            split.append(words)
        known: dict[str, bytes] = {t: struct.pack("<I", i) for t, i in self.added.items()}
        fresh = []
        for word in set().union(*split) - known.keys():
            code = self._young.get(word)
            if code is None:
                code = self._old.get(word)
                if code is None:
                    fresh.append(word)
                    continue
                self._young[word] = code
            known[word] = code
        found = self.encode_words(fresh)
        known.update(found)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        self._young.update((w, c) for w, c in found.items() if len(w) <= LONG_WORD)
        if len(self._young) > KEPT_WORDS // 2:  # words that aren't met again while the next half fills go
            self._old, self._young = self._young, {}
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(content: str) -> Vocabulary:
    return Vocabulary(content)


def encode_documents(df: DataFrame, text: str = "text", vocabulary: str | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """The columns given (but those named like the results or the text), `ids` (binary, little-endian 32-bit) and `decoded` of every whole text.

    vocabulary is the path of a tokenizer file on the driver; its content, a few MB whatever the
    input, goes to the workers once; a file whose settings are not those of a plain byte-level model
    is refused. A null text counts as empty and has no ids; strings of added tokens are encoded as
    these, by their flags; a text of any length is encoded whole, and a long one alone; repeated rows
    give equal results; an empty table gives none.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        content = ship(df.sparkSession).sparkContext.broadcast(file.read())
    work = df.select(*[F.col(f"`{c}`") for c in columns if c.lower() not in (text.lower(), "ids", "decoded")], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _loaded(content.value)
        for batch in chunks(batches, limit=2 * CHUNK_BYTES):
            encoded = vocab.encode_batch(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(encoded, pa.binary()), pa.array(map(vocab.decode, encoded), pa.string())],
                names=[*batch.schema.names[:-1], "ids", "decoded"],
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in work.dtypes[:-1])
    return work.mapInArrow(run, f"{fields}{', ' if fields else ''}ids binary, decoded string")


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The contract's columns for a table of documents."""
    made = encode_documents(clean_columns(docs, doc_id="bigint", text="string"), vocabulary=vocabulary, columns=("doc_id",))
    return made.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
