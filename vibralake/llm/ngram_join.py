"""N-gram Jaccard join as a blocked sparse matrix product of the document by n-gram incidence.

Rows of the matrix are nodes, one for each distinct set of shingles (equal sets are one node from
the start); columns are shingles. Size-derived bounds decide what is multiplied:

* A pair of sizes x, y needs an overlap of at least t/(1+t) * (x+y). With the columns of a row
  ordered from rare to frequent (by a count sketch of fixed size, ties by hash), the pair's first
  common column at places p, q allows at most min(x-p, y-q); so only a prefix of each row takes
  part, and an entry only meets rows within its bounds of size.
* Columns with one entry are dropped by sharded Bloom filters: those of as many shards as fit a bound
  are broadcast at once, and entries are read once for each such run of shards.

The product is then taken in two rounds, so that a large group of near copies never emits all pairs:
in the first, each row is multiplied with the most central row of its columns only (a star), and
linked rows become components; in the second, columns are cut into blocks, and only entries of
different components are multiplied. Pairs that pass the bounds get their overlap counted exactly
from the full rows. No pair of different components that could reach the threshold is left out.

So components are exact, but pairs inside of one aren't all multiplied. Links, where they are asked
for, are counted afterwards: a component's rows are dealt into blocks of bounded size, and each
block is multiplied with itself and the others of its component, over the full rows.

Staged tables and the shuffle files behind them are deleted as soon as nothing reads them any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vibralake.llm.bloom import CODES, code_batch, in_turns, mixed, shard_of
from vibralake.llm.components import components
from vibralake.llm.shared import LOWER, UPPER, chunks, clean_columns, dropped, row_keys, ship, staged
from vibralake.llm.substring import Rolling, word_hashes

WORDS, PERCENT = 5, 80
#: Counters of the sketch that orders columns (fixed size, 4 MB), bytes of broadcast filters, entries in a block.
SKETCH, SKETCH_BLOCKS, FILTER_BYTES, BLOCK = 1 << 20, 128, 32 << 20, 4096
#: Rows and shingles of a block whose links are counted, on average.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20
#: Products taken at once in a task.
PRODUCT = 1 << 19


class Rows:
    """Distinct shingles of a chunk of texts, sorted by document and hash."""

    def __init__(self, texts: pa.Array, words: int) -> None:
        hashes, counts = word_hashes(texts, fold=True)
        firsts = np.cumsum(counts) - counts
        many = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
        doc = np.repeat(np.arange(len(counts)), many)
        begin = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + firsts[doc]
        code = Rolling(hashes, 0).of(begin, np.minimum(begin + words, firsts[doc] + counts[doc]))
        ends = np.cumsum(many)
        own = [np.unique(code[e - n : e]) for e, n in zip(ends.tolist(), many.tolist(), strict=True)]
        self.size = np.array([len(x) for x in own], np.int64)
        self.code = np.concatenate(own) if own else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(counts)), self.size)
        self.first = np.cumsum(self.size) - self.size
        self.node = [np.zeros(len(counts), np.uint64) for _ in range(2)]
        some = np.flatnonzero(self.size)
        if len(some):
            for i in range(2):
                self.node[i][some] = np.add.reduceat(mixed(self.code, 31 + i), self.first[some])

    def prefixes(self, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, code and place of each prefix entry, columns ordered from rare to frequent."""
        rarity = sketch[self.code & np.uint64(SKETCH - 1)]
        length = np.where(self.size > 0, self.size + (-percent * self.size // 100) + 1, 0)  # size - ceil(t * size) + 1
        spans = zip(self.first.tolist(), self.size.tolist(), length.tolist(), strict=True)
        chosen = np.concatenate([f + np.argsort(rarity[f : f + n], kind="stable")[:k] for f, n, k in spans] or [np.zeros(0, np.int64)]).astype(np.int64)
        return self.doc[chosen], self.code[chosen], np.arange(len(chosen)) - np.repeat(np.cumsum(length) - length, length)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _batch(arrays: list[pa.Array], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names.split())


def _held(known: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose first column is a code in the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(known.value.has(batch.column(0).to_numpy().view(np.uint64))))

    return run


def _within(n: Column, place: Column, m: Column, percent: int) -> Column:
    """Whether a row of size m can be linked with one of size n whose first common column is at place."""
    return (100 * m >= percent * n) & (percent * m <= (100 + percent) * (n - place) - percent * n)


def _linked(pairs: DataFrame, nodes: DataFrame, work: DataFrame, words: int, percent: int, filter_bytes: int) -> DataFrame:
    """Of pairs (a1, a2, b1, b2), a staged table, those whose overlap, counted over the full rows, reaches the threshold; pairs is deleted."""
    spark = work.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hubs = pairs.groupBy("b1", "b2").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    members = pairs.join(hubs, ["b1", "b2"]).select("a1", "a2", "b1", "b2", F.pmod(F.xxhash64("a1", "a2"), "parts").cast("int").alias("part"), F.lit(1).alias("role"))
    heads = hubs.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), "b1", "b2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    wanted = staged(
        members.unionByName(heads).join(nodes.select(F.col("n1").alias("a1"), F.col("n2").alias("a2"), "key_a", "key_b"), ["a1", "a2"]), "wanted"
    )

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.unique(batch.column(0).to_numpy().view(np.uint64))
            yield code_batch(made, np.zeros(len(made), bool), shards)

    own = work.select("key_a", "key_b", "text")
    found, turns = [], []
    for known, low, high, every in in_turns(wanted.select("key_a").mapInArrow(codes, CODES), False, filter_bytes, "wanted-filters"):
        mine = own if every else own.filter(shard_of("key_a", shards).between(low, high))
        found.append(mine.mapInArrow(_held(known), "key_a bigint, key_b bigint, text string").dropDuplicates(["key_a", "key_b"]))
        if not every:
            found[-1] = staged(found[-1], "texts")
            turns.append(found[-1])
            known.destroy()
    texts = reduce(DataFrame.unionByName, found)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = Rows(batch.column(batch.num_columns - 1), words)
            made = [rows.code[f : f + n].tobytes() for f, n in zip(rows.first.tolist(), rows.size.tolist(), strict=True)]
            yield _batch([*batch.columns[:-1], pa.array(made, pa.binary())], "b1 b2 part role a1 a2 codes")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for b1, b2, part, role, a1, a2, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = np.frombuffer(raw, np.uint64)
                if role == 0:
                    hub, own = (b1, b2, part), row
                    continue
                if hub != (b1, b2, part):
                    raise ValueError("a member came without its hub")
                overlap = int(np.count_nonzero(own[np.minimum(np.searchsorted(own, row), len(own) - 1)] == row))
                if 100 * overlap >= percent * (len(own) + len(row) - overlap):
                    out.append((a1, a2, b1, b2))
            yield _batch([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], "a1 a2 b1 b2")

    sets = wanted.join(texts, ["key_a", "key_b"]).select("b1", "b2", "part", "role", "a1", "a2", "text")
    sets = sets.mapInArrow(full, "b1 bigint, b2 bigint, part int, role int, a1 bigint, a2 bigint, codes binary")
    order = ["b1", "b2", "part"]
    links = staged(sets.repartition(*order).sortWithinPartitions(*order, "role").mapInArrow(counted, "a1 bigint, a2 bigint, b1 bigint, b2 bigint"), "links")
    dropped(wanted, pairs, *turns)
    return links


def _blocks(index: DataFrame, percent: int) -> DataFrame:
    """Pairs of entries (code, n1, n2, size, place, root1, root2) of different components within their bounds.

    Of each column, the entries outside its most central component are held in blocks, and all
    entries stream past them; both are dealt out over parts of bounded size.
    """
    column = index.groupBy("code").agg(
        F.min(F.struct("place", "size", "root1", "root2")).alias("top"), F.count("*").alias("m"), F.min(F.struct("root1", "root2")).alias("r"), F.max(F.struct("root1", "root2")).alias("s")
    )
    several = column.filter("r <> s").select("code", "top.root1", "top.root2", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts")).withColumnsRenamed({"root1": "top1", "root2": "top2"})
    rows = index.join(several, "code")
    deal = F.pmod(F.xxhash64("n1", "n2"), "parts").cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    fields = ["code", "n1", "n2", "size", "place", "root1", "root2"]
    held = rows.filter("root1 <> top1 or root2 <> top2").select(*fields, deal.alias("held"), every.alias("flow"), F.lit(0).alias("role"))
    flow = rows.select(*fields, every.alias("held"), deal.alias("flow"), F.lit(1).alias("role"))
    order = ["code", "held", "flow"]

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = np.zeros((10, 0), np.int64)  # the held rows of the last block: code held flow role n1 n2 size place root1 root2
        for batch in batches:
            data = np.concatenate([carry, np.array([c.to_numpy() for c in batch.columns], np.int64).reshape(10, -1)], axis=1)
            if not data.shape[1]:
                continue
            fresh = np.ones(data.shape[1], bool)
            fresh[1:] = np.any(data[:3, 1:] != data[:3, :-1], axis=0)
            starts, block = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            kept = np.add.reduceat(data[3] == 0, starts, dtype=np.int64)
            rows = np.flatnonzero(data[3] == 1)
            rows = rows[kept[block[rows]] > 0]
            many, at = kept[block[rows]], 0
            total = np.cumsum(many)
            while at < len(rows):
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PRODUCT, "right")))
                n = many[at:end]
                i = np.repeat(rows[at:end], n)
                j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[block[i]]
                n1, p1, n2, p2 = data[6, i], data[7, i], data[6, j], data[7, j]
                fits = (100 * n2 >= percent * n1) & (percent * n2 <= (100 + percent) * (n1 - p1) - percent * n1)
                fits &= (100 * n1 >= percent * n2) & (percent * n1 <= (100 + percent) * (n2 - p2) - percent * n2)
                fits &= (data[8, i] != data[8, j]) | (data[9, i] != data[9, j])
                a, b = data[4:6, i[fits]], data[4:6, j[fits]]
                turn = (a[0] > b[0]) | (a[0] == b[0]) & (a[1] > b[1])
                both = np.unique(np.concatenate([np.where(turn, b, a), np.where(turn, a, b)]), axis=1)
                if both.shape[1]:
                    yield _batch([pa.array(c) for c in both], "a1 a2 b1 b2")
                at = end
            carry = data[:, starts[-1] : starts[-1] + kept[-1]]

    dealt = held.unionByName(flow).select(*order, "role", *fields[1:]).repartition(*order).sortWithinPartitions(*order, "role")
    return dealt.mapInArrow(multiplied, "a1 bigint, a2 bigint, b1 bigint, b2 bigint").distinct()


class Block:
    """Rows of a component (node, copies, shingles), gathered until it is multiplied with others."""

    def __init__(self) -> None:
        self.node: list[tuple[int, int]] = []
        self.weight: list[int] = []
        self.codes: list[np.ndarray] = []
        self.made = False

    def add(self, node: tuple[int, int], copies: int, codes: np.ndarray) -> None:
        self.node.append(node)
        self.weight.append(copies)
        self.codes.append(codes)

    def finish(self) -> None:
        self.size = np.array([len(c) for c in self.codes], np.int64)
        every = np.concatenate(self.codes)
        order = np.argsort(every, kind="stable")
        self.code, self.row = every[order], np.repeat(np.arange(len(self.size)), self.size)[order]
        self.copies = np.array(self.weight, np.int64)
        self.links = np.zeros(len(self.size), np.int64)
        self.made = True

    def linked(self, codes: np.ndarray, percent: int) -> np.ndarray:
        """Which rows are linked with a row of these shingles."""
        low, high = np.searchsorted(self.code, codes), np.searchsorted(self.code, codes, "right")
        n = high - low
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        overlap = np.bincount(self.row[at], minlength=len(self.size))
        return (overlap > 0) & (100 * overlap >= percent * (self.size + len(codes) - overlap))


def _links(member: DataFrame, work: DataFrame, words: int, percent: int) -> DataFrame:
    """For nodes (n1, n2, r1, r2, copies, n, key_a, key_b) of components with several, how many rows of other nodes each is linked with: n1, n2, more."""
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    several = member.groupBy("r1", "r2").agg(F.count("*").alias("m"), parts.alias("parts")).filter("m > 1").drop("m")
    wanted = staged(member.join(several, ["r1", "r2"]).select("key_a", "key_b", "r1", "r2", "parts", "n1", "n2", "copies"), "several")
    texts = work.select("key_a", "key_b", "text").join(wanted.select("key_a", "key_b"), ["key_a", "key_b"], "left_semi").dropDuplicates(["key_a", "key_b"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = Rows(batch.column(batch.num_columns - 1), words)
            made = [rows.code[f : f + n].tobytes() for f, n in zip(rows.first.tolist(), rows.size.tolist(), strict=True)]
            yield _batch([*batch.columns[:-1], pa.array(made, pa.binary())], "r1 r2 parts n1 n2 copies codes")

    sets = wanted.join(texts, ["key_a", "key_b"]).select("r1", "r2", "parts", "n1", "n2", "copies", "text")
    sets = staged(sets.mapInArrow(full, "r1 bigint, r2 bigint, parts int, n1 bigint, n2 bigint, copies bigint, codes binary"), "sets")
    order = ["r1", "r2", "held", "flow"]
    deal = F.pmod(F.xxhash64("n1", "n2"), "parts").cast("int")
    rest = ["n1", "n2", "copies", "codes"]
    # the rows of a block come first (role 0), then those of a block after it; a block meets itself where held = flow
    held = sets.select("r1", "r2", "parts", *rest, deal.alias("held")).withColumn("flow", F.explode(F.sequence(F.col("held"), F.col("parts") - 1)))
    flow = sets.select("r1", "r2", *rest, deal.alias("flow")).filter("flow > 0").withColumn("held", F.explode(F.sequence(F.lit(0), F.col("flow") - 1)))
    dealt = held.select(*order, F.lit(0).alias("role"), *rest).unionByName(flow.select(*order, F.lit(1).alias("role"), *rest))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, Block()
        out: list[tuple[int, int, int]] = []

        def close() -> None:
            if not block.node:
                return
            if at[2] == at[3]:
                block.finish()
                for i, codes in enumerate(block.codes):
                    hit = block.linked(codes, percent)
                    hit[i] = False
                    block.links[i] = block.copies[hit].sum()
            if block.made:
                out.extend((*node, n) for node, n in zip(block.node, block.links.tolist(), strict=True) if n)

        def rows() -> pa.RecordBatch:
            made = _batch([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], "n1 n2 more")
            out.clear()
            return made

        for batch in batches:
            for r1, r2, held, flow, role, n1, n2, copies, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (r1, r2, held, flow) != at:
                    close()
                    at, block = (r1, r2, held, flow), Block()
                codes = np.frombuffer(raw, np.uint64)
                if role == 0:
                    block.add((n1, n2), copies, codes)
                elif block.node:
                    if not block.made:
                        block.finish()
                    hit = block.linked(codes, percent)
                    block.links[hit] += copies
                    out.append((n1, n2, int(block.copies[hit].sum())))
            yield rows()
        close()
        yield rows()

    dealt = dealt.repartition(*order).sortWithinPartitions(*order, "role")
    return dealt.mapInArrow(counted, "n1 bigint, n2 bigint, more bigint").groupBy("n1", "n2").agg(F.sum("more").alias("more"))


def link_components(
    df: DataFrame, identifier: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, filter_bytes: int = FILTER_BYTES, links: bool = True
) -> DataFrame:
    """One row per row of df: identifier, n_shingles, component_id, and n_links unless links is off.

    A text's set: its distinct shingles of so many words, A-Z in lower case; with fewer words, the
    whole sequence as one; a null or empty text has none and is linked with nothing. Rows are linked
    if 100 * intersection >= percent * union. component_id is the smallest identifier reachable by
    links, the row's own included; null identifiers count only where there is no other. n_links counts
    the other rows that a row is linked with, those with an equal set included; within a large group
    of near copies that takes all pairs, so leave it out where it isn't needed.
    Repeated rows have equal sets; a text of any length has all its shingles; an empty table gives
    none; further columns are left out.
    """
    spark = ship(df.sparkSession)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = df.select(F.col(f"`{identifier}`").cast("bigint").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    work = clean.select(*row_keys("doc", "text"), "doc", "text")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = "doc key_a key_b n1 n2 size block counts"
        counts = np.zeros(SKETCH, np.int64)
        for batch in chunks(batches):
            rows = Rows(batch.column(3), words)
            counts += np.bincount((rows.code & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            none = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield _batch([batch.column(2), batch.column(0), batch.column(1), *map(_signed, rows.node), pa.array(rows.size), *none], names)
        for i, block in enumerate(np.split(counts, SKETCH_BLOCKS)):
            if block.any():
                small = np.minimum(block, np.iinfo(np.int32).max).astype(np.int32)
                yield _batch([*[pa.nulls(1, pa.int64())] * 6, pa.array([i], pa.int32()), pa.array([small.tobytes()], pa.binary())], names)

    made = staged(work.mapInArrow(sized, "doc bigint, key_a bigint, key_b bigint, n1 bigint, n2 bigint, size bigint, block int, counts binary"), "rows")
    docs = made.filter("block is null").drop("block", "counts")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(raw, np.int32).astype(np.int64)
        for i, block in sums.items():
            yield _batch([pa.array([i], pa.int32()), pa.array([block.tobytes()], pa.binary())], "block counts")

    total = np.zeros(SKETCH, np.int64)
    step = SKETCH // SKETCH_BLOCKS
    for row in made.filter("block is not null").select("block", "counts").repartition("block").mapInArrow(added, "block int, counts binary").collect():
        total[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(row["counts"], np.int64)
    sketch = spark.sparkContext.broadcast(np.minimum(total, np.iinfo(np.int32).max).astype(np.int32))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = Rows(batch.column(3), words)
            doc, code, place = rows.prefixes(sketch.value, percent)
            yield _batch([_signed(code), *[_signed(n[doc]) for n in rows.node], pa.array(rows.size[doc]), pa.array(place)], "code n1 n2 size place")

    entry = "code bigint, n1 bigint, n2 bigint, size bigint, place bigint"
    every = staged(work.mapInArrow(prefixes, entry), "prefixes")

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, node = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            order = np.lexsort((node, code))
            code, node = code[order], node[order]
            fresh = np.ones(len(code), bool)
            fresh[1:] = (code[1:] != code[:-1]) | (node[1:] != node[:-1])  # equal sets side by side count once
            found, counts = np.unique(code[fresh], return_counts=True)
            yield code_batch(found, counts > 1, shards)

    parts = []
    for known, low, high, whole in in_turns(every.select("code", "n1").mapInArrow(columns, CODES), True, filter_bytes, "columns"):
        mine = every if whole else every.filter(shard_of("code", shards).between(low, high))
        parts.append(staged(mine.mapInArrow(_held(known), entry).distinct(), "entries"))
        known.destroy()
    dropped(every)
    index = reduce(DataFrame.unionByName, parts)
    nodes = staged(docs.filter("size > 0").groupBy("n1", "n2").agg(F.min("doc").alias("least"), F.count("*").alias("copies"), F.first("size").alias("n"), F.min(F.struct("key_a", "key_b")).alias("key")).select("n1", "n2", "least", "copies", "n", "key.*"), "nodes")

    top = index.groupBy("code").agg(F.min(F.struct("place", "size", "n1", "n2")).alias("top"), F.count("*").alias("m")).filter("m > 1").select("code", "top")
    star = (
        index.join(top, "code")
        .filter("n1 <> top.n1 or n2 <> top.n2")
        .filter(_within(F.col("size"), F.col("place"), F.col("top.size"), percent) & _within(F.col("top.size"), F.col("top.place"), F.col("size"), percent))
        .groupBy("n1", "n2", F.col("top.n1").alias("b1"), F.col("top.n2").alias("b2"))
        .agg(F.count("*").alias("shared"))
        .groupBy("n1", "n2")
        .agg(F.max(F.struct("shared", "b1", "b2")).alias("best"))
        .select(F.col("n1").alias("a1"), F.col("n2").alias("a2"), "best.b1", "best.b2")
    )
    first = _linked(staged(star, "star"), nodes, work, words, percent, filter_bytes)
    edge = lambda links: links.select(F.struct("a1", "a2").alias("u"), F.struct(F.col("b1").alias("a1"), F.col("b2").alias("a2")).alias("v"))
    roots = components(edge(first)).select(F.col("node.a1").alias("n1"), F.col("node.a2").alias("n2"), F.col("root.a1").alias("root1"), F.col("root.a2").alias("root2"))
    coloured = index.join(roots, ["n1", "n2"], "left").select(
        "code", "n1", "n2", "size", "place", F.coalesce("root1", "n1").alias("root1"), F.when(F.col("root1").isNull(), F.col("n2")).otherwise(F.col("root2")).alias("root2")
    )
    coloured = staged(coloured, "coloured")
    dropped(*parts)
    pairs = staged(_blocks(coloured, percent), "pairs")
    dropped(coloured)
    second = _linked(pairs, nodes, work, words, percent, filter_bytes)
    final = components(edge(first.unionByName(second))).select(F.col("node.a1").alias("n1"), F.col("node.a2").alias("n2"), F.col("root.a1").alias("r1"), F.col("root.a2").alias("r2"))
    member = nodes.join(final, ["n1", "n2"], "left").withColumns({"r1": F.coalesce("r1", "n1"), "r2": F.coalesce("r2", "n2")})
    member = staged(member, "members")
    dropped(nodes)
    least = member.groupBy("r1", "r2").agg(F.min("least").alias("component"))
    counts = []
    made = member.join(least, ["r1", "r2"]).select("n1", "n2", "component", "copies")
    if links:
        made = made.join(_links(member, work, words, percent), ["n1", "n2"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("more", F.lit(0)))
        counts = ["n_links"]
    full = docs.filter("size > 0").join(made, ["n1", "n2"]).select("doc", "size", "component", *counts)
    bare = docs.filter("size = 0").select("doc", "size", F.col("doc").alias("component"), *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return full.unionByName(bare).select(F.col("doc").alias(identifier), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"), *counts)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    return link_components(clean_columns(docs, doc_id="bigint", text="string"), links=False)


def sql(documents: str = "documents") -> str:
    """Components in DuckDB SQL: doc_id, n_shingles, component_id."""
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words FROM {documents}),
g AS (SELECT DISTINCT rid, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - {WORDS - 2}), lambda i: array_to_string(words[i:i+{WORDS - 1}], ' ')) END) AS shingle FROM d),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
o AS (SELECT a.rid AS a, b.rid AS b, count(*) AS o FROM g a JOIN g b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * o >= {PERCENT} * (x.n + y.n - o)),
r AS (SELECT rid, rid AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.rid)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) JOIN r USING (rid) JOIN d t ON t.rid = r.root GROUP BY d.rid, d.doc_id, n.n"""


SQL = sql()
