"""Exact deduplication with Patricia tries as owners of texts.

1. Each input task inserts its rows' full byte strings into a compressed radix trie. A terminal
   node stores the smallest identifier seen and a count, so a text leaves a task once (or once per
   flush of the trie), however many copies the task has: hot texts shrink before the shuffle.
2. What is left is dealt into partitions by length and content hash. A partition's strings arrive in
   their own order and are inserted into the owner's trie, whose edges they share as far as they
   begin alike. When the trie is over its memory budget, every subtree beside the path of the current
   string is complete, as what follows sorts after it; all are given out and dropped. What the memory
   can't hold waits, sorted by subtree, in Spark's own external sort.
3. Decisions go back to rows by the number of their local group, a key that is never hot.

Equality is that of full byte strings; hashes only place them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import LOWER, UPPER, chunks, clean_columns, ship, staged

#: Bytes of labels and nodes that a trie may hold in a task before it gives out subtrees.
TRIE_BYTES = 48 << 20
NODE_BYTES = 300
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


class Node:
    """A node of a Patricia trie: the bytes on the edge to it, children by first byte, data if a key ends here."""

    __slots__ = ("children", "data", "label")

    def __init__(self, label: bytes, data: list | None = None) -> None:
        self.label, self.children, self.data = label, {}, data


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Maps byte strings to lists; size is an estimate of its memory."""

    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def at(self, key: bytes) -> Node:
        """The terminal node of key, made where it is missing (its data is None then)."""
        node, begin = self.root, 0
        while begin < len(key):
            child = node.children.get(key[begin])
            if child is None:
                child = node.children[key[begin]] = Node(key[begin:])
                self.size += NODE_BYTES + len(child.label)
                return child
            if not key.startswith(child.label, begin):
                rest = key[begin : begin + len(child.label)]
                n = _shared(rest, child.label)
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[key[begin]] = upper
                self.size += NODE_BYTES
                child = upper
            node, begin = child, begin + len(child.label)
        return node

    def take(self, keep: bytes | None = None) -> Iterator[tuple[bytes, list]]:
        """Give out and drop all subtrees but that of keep."""
        stack, kept = [(self.root, b"")], []
        while stack:
            node, above = stack.pop()
            key = above + node.label
            if node.data is not None:
                if keep is not None and key.startswith(keep):
                    kept.append((key, node.data))
                else:
                    yield key, node.data
            stack.extend((child, key) for child in node.children.values())
        self.root, self.size = Node(b""), 0
        for key, data in kept:
            self.at(key).data = data


def _local(batches: Iterator[pa.RecordBatch], budget: int = TRIE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows (row, rank, grp) and groups (grp, rank, row, count, text, length, hash, sha)."""
    names = ["row", "rank", "grp", "copies", "text", "length", "hash", "sha"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    base = TaskContext.get().partitionId() << 40
    rows = groups = 0
    trie = Trie()

    def given() -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for key, (grp, rank, row, copies) in trie.take():
            out.append((row, rank, grp, copies, key, len(key), xxhash.xxh3_64_intdigest(key) - (1 << 63), hashlib.sha256(key).digest()))
            held += len(key)
            if held > 4 << 20:
                yield made(out)
                out, held = [], 0
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=names)

    for batch in chunks(batches):
        out = []
        for rank, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            folded = (text or "").encode().translate(_FOLD)
            node = trie.at(folded)
            row = base + rows
            rows += 1
            if node.data is None:
                node.data = [base + groups, rank, row, 1]
                groups += 1
            else:
                node.data[3] += 1
                if rank is not None and (node.data[1] is None or (rank, row) < (node.data[1], node.data[2])):
                    node.data[1:3] = rank, row
            out.append((row, rank, node.data[0], None, None, None, None, None))
        yield made(out)
        if trie.size > budget:
            yield from given()
    yield from given()


def _owners(batches: Iterator[pa.RecordBatch], budget: int = TRIE_BYTES) -> Iterator[pa.RecordBatch]:
    """For each local group the owner of its text: (grp, keep_rank, keep_row, group_size, sha)."""
    trie = Trie()
    names = ["grp", "keep_rank", "keep_row", "group_size", "sha"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def given(keep: bytes | None) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, (members, rank, row, size, sha) in trie.take(keep):
            out.extend((m, rank, row, size, sha) for m in members)
            if len(out) > 20_000:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=names)

    for batch in chunks(batches):
        for row, rank, grp, copies, text, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            node = trie.at(text)
            if node.data is None:
                node.data = [[grp], rank, row, copies, sha]
            else:
                node.data[0].append(grp)
                node.data[3] += copies
                if rank is not None and (node.data[1] is None or (rank, row) < (node.data[1], node.data[2])):
                    node.data[1:3] = rank, row
            if trie.size > budget:
                yield from given(text)
    yield from given(None)


def exact_groups(df: DataFrame, identifier: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of df: identifier, keep_id, group_size, kept, text_sha.

    Texts are equal if identical after lower-casing A-Z; a null counts as empty. Of equal texts,
    the row with the smallest (or keep="largest") identifier stays; a null identifier comes last;
    of repeated rows with that identifier exactly one stays. text_sha is the SHA-256 of the
    normalised text. A text of any length is held whole. Other columns are left out. An empty table
    gives an empty result.
    """
    ship(df.sparkSession)
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    number = F.col(f"`{identifier}`").cast("bigint")
    turned = (lambda c: c) if keep == "smallest" else F.bitwise_not  # reverses the order without overflow
    work = df.select(turned(number).alias("rank"), F.col(f"`{text}`").cast("string").alias("text"))
    local = staged(
        work.mapInArrow(_local, "row bigint, rank bigint, grp bigint, copies bigint, text binary, length bigint, hash bigint, sha binary"), "exact-dedup"
    )
    owners = (
        local.filter("copies is not null")
        .repartition("length", "hash")
        .sortWithinPartitions("text")
        .select("row", "rank", "grp", "copies", "text", "sha")
        .mapInArrow(_owners, "grp bigint, keep_rank bigint, keep_row bigint, group_size bigint, sha binary")
    )
    rows = local.filter("copies is null").select("row", "rank", "grp")
    return rows.join(owners, "grp").select(
        turned(F.col("rank")).alias(identifier),
        turned(F.col("keep_rank")).alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "sha",
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    found = exact_groups(clean_columns(docs, doc_id="bigint", text="string"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)"""
