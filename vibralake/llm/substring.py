"""Substring deduplication by relative Lempel-Ziv parsing with content-defined phrases.

Removes every word covered by a window of so many words whose sequence also starts anywhere else.

A document is parsed from left to right into phrases against the indexed blocks of the whole corpus:

* Every window has an anchor, the least k-word hash inside it, so equal windows have equal anchors.
  A phrase is the stretch of words under a run of windows that share an anchor.
* A block is a shard of the anchors, with the phrases under them as its index. A phrase only ever
  needs the block that its anchor belongs to, so every document is held against every block that
  could match it, and no document is compared with another.
* Phrases found twice in a block make factors; they are long enough by construction.
* At factor boundaries a phrase has a repeated anchor but no whole equal. There, and for one
  representative of each repeated phrase under the same anchor, the windows themselves are indexed
  and greedily matched, so factors end exactly where the repetition does.

Phrases and windows are identified by 128-bit hashes: two of 64 bits, each built from word hashes of
its own, so that words that collide in one don't in the other.

An anchor or phrase that a large share of the corpus holds would put all its rows in one task: those
with more rows than a fair part are dealt out over several, and what they are joined with is copied
to each of these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vibralake.llm.bloom import CODES, code_batch, mixed, sharded
from vibralake.llm.shared import chunks, clean_columns, row_keys, ship, staged

WINDOW, ANCHOR = 35, 8
#: Rows of an anchor or phrase that one task takes whatever the input is.
FAIR_ROWS = 10_000
#: Bound in bytes of the broadcast filter of boundary phrases; beyond it, they are joined to documents.
FILTER_BYTES = 32 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: pa.Array, fold: bool = False, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts (fold: A-Z in lower case), and the number of words of each text.

    separator: for each byte, whether it parts words.
    """
    (hashes,), counts = several_hashes(texts, fold, separator, 1)
    return hashes, counts


def several_hashes(texts: pa.Array, fold: bool, separator: np.ndarray, many: int) -> tuple[list[np.ndarray], np.ndarray]:
    """So many independent hashes of each word, and the number of words of each text."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    if offsets[0] == offsets[-1]:
        return [np.zeros(0, np.uint64)] * many, np.zeros(len(texts), np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    if fold:
        raw = _FOLDED[raw]
    inside = ~separator[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * many, np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(starts, offsets))
    letters = np.flatnonzero(inside)
    word = np.cumsum(begins)[letters] - 1
    place = letters - starts[word]
    heads = np.searchsorted(letters, starts)
    values = raw[letters]
    places = np.arange(place.max() + 1, dtype=np.uint64)
    del inside, begins, word, letters
    out = []
    for i in range(many):
        terms = mixed(places, 5 + 100 * i)[place]
        terms *= values + np.uint64(1)
        out.append(mixed(np.add.reduceat(terms, heads), 7 + 100 * i))
    return out, counts


class Rolling:
    """Hashes of word sequences [begin, end) from prefix sums, in the ring of 64-bit integers."""

    def __init__(self, words: np.ndarray, which: int) -> None:
        base = _BASES[which]
        n = len(words)
        powers = np.full(n + 1, np.uint64(base))
        powers[0] = 1
        self.inverse = np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)))
        self.inverse[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers[:n], out=self.sums[1:])
        self.which = which

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin], 13 + self.which)


class Parsed:
    """Phrases of a chunk of texts: document number, first window in it, number of windows, anchor; hashes on demand."""

    def __init__(self, texts: pa.Array, window: int, anchor: int) -> None:
        both, self.counts = several_hashes(texts, False, _SEPARATOR, 2)
        words = both[0]
        self.window = window
        self.rolling = [Rolling(w, i) for i, w in enumerate(both)]
        firsts = np.concatenate([[0], np.cumsum(self.counts)])
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        n = len(words) - window + 1
        at = np.flatnonzero(doc[:n] == doc[window - 1 :]) if n > 0 else np.zeros(0, np.int64)
        if not len(at):
            self.doc = self.start = self.windows = self.place = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        grams = np.arange(len(words) - anchor + 1)
        hashes = self.rolling[0].of(grams, grams + anchor)
        wide = np.lib.stride_tricks.sliding_window_view(hashes, window - anchor + 1)
        least = np.empty(n, np.int64)
        for i in range(0, n, 1 << 16):
            least[i : i + (1 << 16)] = wide[i : i + (1 << 16)].argmin(axis=1)
        chosen = at + least[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(fresh)
        self.place = at[heads]
        self.windows = np.diff(np.append(heads, len(at)))
        self.doc = doc[self.place]
        self.start = self.place - firsts[self.doc]
        self.anchor = hashes[chosen[heads]]

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        end = self.place + self.windows + (self.window - 1)
        return self.rolling[0].of(self.place, end), self.rolling[1].of(self.place, end)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _located(code: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A code for a phrase at a place."""
    return mixed(code ^ mixed(key, 17) ^ start.astype(np.uint64) * np.uint64(_BASES[1]), 19)


def dealt_join(rows: DataFrame, side: DataFrame, keys: list[str], sizes: DataFrame, total: int) -> DataFrame:
    """rows (with key_a and start) joined with side by keys; sizes (keys, n) says how many rows a key has.

    Keys with more than limit rows are dealt over parts. They are at most 4 for a shuffle partition.
    """
    spark = rows.sparkSession
    limit = max(FAIR_ROWS, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = sizes.filter(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("parts"))
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema))
    parts = F.coalesce("parts", F.lit(1)).cast("bigint")
    spread = rows.join(hot, keys, "left").withColumn("part", F.pmod(F.xxhash64("key_a", "start"), parts)).drop("parts")
    copied = side.join(hot, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("parts")
    return spread.join(copied, [*keys, "part"]).drop("part")


def duplicate_spans(work: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """For work (key_a, key_b, text), the spans of words to remove: key_a, key_b, spans array<struct<begin, end>>."""
    spark = work.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found, counts = np.unique(Parsed(batch.column(2), window, anchor).anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(counts)], names=["anchor", "n"])

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            parsed = Parsed(batch.column(2), window, anchor)
            a, b = parsed.phrases()
            key_a, key_b = (batch.column(i).to_numpy()[parsed.doc] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [_signed(parsed.anchor), _signed(a), _signed(b), pa.array(key_a), pa.array(key_b), pa.array(parsed.start.astype(np.int32)), pa.array(parsed.windows.astype(np.int32))],
                names=["anchor", "code_a", "code_b", "key_a", "key_b", "start", "windows"],
            )

    repeated = staged(work.mapInArrow(anchors, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"), "anchors")
    rows = work.mapInArrow(phrases, "anchor bigint, code_a bigint, code_b bigint, key_a bigint, key_b bigint, start int, windows int")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    index = staged(dealt_join(rows, repeated.select("anchor"), ["anchor"], repeated, total), "phrases")
    counted = staged(
        index.groupBy("code_a", "code_b").agg(F.count("*").alias("n"), F.min("anchor").alias("anchor"), F.min(F.struct("key_a", "key_b", "start")).alias("one")),
        "phrase-counts",
    )
    found = counted.filter("n > 1").select("code_a", "code_b", "n")
    factors = dealt_join(index, found.drop("n"), ["code_a", "code_b"], found, total).select(
        "key_a", "key_b", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + window - 1).alias("end")
    )

    phrases_of = staged(counted.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if(F.col("n") == 1).alias("single")).filter("single > 0").select("anchor", "n"), "open-anchors")
    single = counted.select("anchor", "code_a", "one.key_a", "one.key_b", "one.start")
    borders = staged(dealt_join(single, phrases_of.select("anchor"), ["anchor"], phrases_of, total).select("code_a", "key_a", "key_b", "start"), "borders")

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.unique(_located(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64), batch.column(3).to_numpy()))
            yield code_batch(made, np.zeros(len(made), bool), shards)

    known = sharded(borders.mapInArrow(codes, CODES), False, filter_bytes, "border-filters")

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            parsed = Parsed(batch.column(2), window, anchor)
            key_a, key_b = (batch.column(i).to_numpy() for i in (0, 1))
            if known is not None:
                wanted = known.value.has(_located(parsed.phrases()[0], key_a[parsed.doc].view(np.uint64), parsed.start))
            else:
                listed = [set(x) for x in batch.column(3).to_pylist()]
                wanted = np.array([s in listed[d] for d, s in zip(parsed.doc.tolist(), parsed.start.tolist(), strict=True)], bool)
            many = parsed.windows[wanted]
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place, doc = np.repeat(parsed.place[wanted], many) + step, np.repeat(parsed.doc[wanted], many)
            begin = np.repeat(parsed.start[wanted], many) + step
            yield pa.RecordBatch.from_arrays(
                [*[_signed(r.of(place, place + window)) for r in parsed.rolling], pa.array(key_a[doc]), pa.array(key_b[doc]), pa.array(begin.astype(np.int32))],
                names=["code_a", "code_b", "key_a", "key_b", "begin"],
            )

    schema = "code_a bigint, code_b bigint, key_a bigint, key_b bigint, begin int"
    if known is not None:
        edges = work.select("key_a", "key_b", "text").mapInArrow(windows_of, schema)
    else:
        lists = borders.groupBy("key_a", "key_b").agg(F.collect_set("start").alias("starts"))
        edges = work.join(lists, ["key_a", "key_b"]).select("key_a", "key_b", "text", "starts").mapInArrow(windows_of, schema)
    edges = staged(edges, "border-windows")
    twice = edges.groupBy("code_a", "code_b").agg(F.count("*").alias("n")).filter("n > 1").select("code_a", "code_b")
    matched = edges.join(twice, ["code_a", "code_b"]).select("key_a", "key_b", "begin", (F.col("begin") + window).alias("end"))
    # Windows and factors that overlap become one span before a document's spans are gathered.
    own = Window.partitionBy("key_a", "key_b").orderBy("begin", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    every = factors.unionByName(matched).withColumn("fresh", (F.col("begin") > F.coalesce(before, F.lit(-1))).cast("int"))
    every = every.withColumn("island", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    spans = every.groupBy("key_a", "key_b", "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return spans.groupBy("key_a", "key_b").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def dedup_substrings(df: DataFrame, identifier: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of df: identifier, text (kept words joined by one blank), n_words, n_removed.

    Words are runs of characters other than ASCII white space, unchanged. Each word is removed that
    is covered by a window of consecutive words of one row whose sequence also starts elsewhere, in
    the same row or another; all occurrences go, none is kept. A null or empty text has no words;
    texts shorter than a window stay; a text of any length is parsed whole; repeated rows are
    occurrences of their own; an empty table gives an empty result; further columns are left out.
    """
    ship(df.sparkSession)
    clean = df.select(F.col(f"`{identifier}`").cast("bigint").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    keyed = clean.select(*row_keys("doc", "text"), "text", "doc")
    spans = duplicate_spans(keyed.select("key_a", "key_b", "text"), window, anchor, filter_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts, total, removed = [], [], []
            for value, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = _WORD.findall(value)
                total.append(len(words))
                if found:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, [s["begin"] for s in found], 1)
                    np.add.at(edge, [s["end"] for s in found], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                removed.append(total[-1] - len(words))
                texts.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=["doc", "text", "n_words", "n_removed"])

    both = keyed.join(spans, ["key_a", "key_b"], "left").select("doc", "text", "spans")
    out = both.mapInArrow(cut, "doc bigint, text string, n_words bigint, n_removed bigint")
    return out.select(F.col("doc").alias(identifier), F.col("text").alias(text), "n_words", "n_removed")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    found = dedup_substrings(clean_columns(docs, doc_id="bigint", text="string"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT rid, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM d WHERE len(words) >= {WINDOW}),
h AS (SELECT rid, i, md5(array_to_string(words[i:i+{WINDOW - 1}], ' ')) AS code FROM w),
r AS (SELECT rid, i FROM h WHERE code IN (SELECT code FROM h GROUP BY code HAVING count(*) > 1)),
c AS (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) AS i FROM r),
g AS (SELECT rid, list(i) AS gone FROM c GROUP BY rid),
p AS (SELECT rid, doc_id, unnest(range(1, len(words) + 1)) AS i, words FROM d),
k AS (SELECT p.rid, string_agg(words[p.i], ' ' ORDER BY p.i) FILTER (c.i IS NULL) AS kept FROM p LEFT JOIN c ON p.rid = c.rid AND p.i = c.i GROUP BY p.rid)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)"""
