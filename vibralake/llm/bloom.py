"""Bloom filters over 64-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import dropped, staged, tidy


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """An independent 64-bit hash of 64-bit codes."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bloom:
    """A Bloom filter that grows by layers: 16 bits for a key, 6 probes, a layer's capacity fourfold the last one's."""

    PROBES, BITS = 6, 16

    def __init__(self, capacity: int = 4096, layers: list[np.ndarray] | None = None) -> None:
        self.layers = layers if layers is not None else []
        self.capacity, self.room = capacity, 0

    def _places(self, keys: np.ndarray, layer: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64(len(layer) * 8 - 1)
        a, b = mixed(keys, 1), mixed(keys, 2) | np.uint64(1)
        for i in range(self.PROBES):
            yield (a + np.uint64(i) * b) & mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for layer in self.layers:
            there = np.ones(len(keys), bool)
            for at in self._places(keys, layer):
                there &= (layer[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            found |= there
        return found

    def add(self, keys: np.ndarray) -> None:
        while len(keys):
            if self.room == 0:
                self.room = self.capacity * 4 ** len(self.layers)
                self.layers.append(np.zeros(self.room * self.BITS // 8, np.uint8))
            part, keys = keys[: self.room], keys[self.room :]
            for at in self._places(part, self.layers[-1]):
                np.bitwise_or.at(self.layers[-1], at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            self.room -= len(part)


class Sharded:
    """Filters by shard = code modulo the number of shards."""

    def __init__(self, shards: int, layers: dict[int, list[np.ndarray]]) -> None:
        self.shards, self.layers = shards, layers

    def has(self, codes: np.ndarray) -> np.ndarray:
        shard, hit = codes % np.uint64(self.shards), np.zeros(len(codes), bool)
        for s in np.unique(shard).tolist():
            if s in self.layers:
                mine = shard == s
                hit[mine] = Bloom(layers=self.layers[s]).has(codes[mine])
        return hit


def _built(codes: DataFrame, repeated: bool, name: str) -> DataFrame:
    """Staged filters (shard, layer, bits) of codes: shard int, code bigint, twice boolean, with shard = code modulo spark.sql.shuffle.partitions.

    repeated=True keeps two filters for a shard, of codes seen once and of codes seen twice (or with
    twice set), and gives the second; otherwise one filter of all codes. The task of a shard holds
    its filters only.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, Bloom] = {}
        out: dict[int, Bloom] = {}
        for batch in batches:
            shard, code = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            again = batch.column(2).to_numpy(zero_copy_only=False)
            for s in np.unique(shard).tolist():
                mine = shard == s
                found, back, counts = np.unique(code[mine], return_inverse=True, return_counts=True)
                wanted = np.ones(len(found), bool)
                if repeated:
                    wanted = counts > 1
                    np.logical_or.at(wanted, back, again[mine])
                    first = once.setdefault(s, Bloom())
                    seen = first.has(found)
                    first.add(found[~seen])
                    wanted |= seen
                given = out.setdefault(s, Bloom(1024))
                given.add(found[wanted & ~given.has(found)])
        for s, filter_ in out.items():
            for i, layer in enumerate(filter_.layers):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([i], pa.int32()), pa.array([layer.tobytes()], pa.binary())], names=["shard", "layer", "bits"])

    return staged(codes.repartition("shard").mapInArrow(build, "shard int, layer int, bits binary"), name)


def _gathered(made: DataFrame, shards: int) -> Broadcast:
    layers: dict[int, list[np.ndarray]] = {}
    for row in made.orderBy("shard", "layer").toLocalIterator():
        layers.setdefault(row["shard"], []).append(np.frombuffer(row["bits"], np.uint8))
    return made.sparkSession.sparkContext.broadcast(Sharded(shards, layers))


def sharded(codes: DataFrame, repeated: bool, limit: int, name: str) -> Broadcast | None:
    """Broadcast filters of codes (as for _built), or None where they are larger than limit bytes, so what comes to the driver is bounded."""
    shards = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = _built(codes, repeated, name)
    if made.selectExpr("coalesce(sum(length(bits)), 0) AS n").first()["n"] > limit:
        return None
    return _gathered(made, shards)


def in_turns(codes: DataFrame, repeated: bool, limit: int, name: str) -> Iterator[tuple[Broadcast, int, int, bool]]:
    """Broadcast filters of codes (as for _built) for one run of shards after another: filters, first shard, last, whether they are all.

    Each run has limit bytes at most, or one shard. Codes whose shard is in no run are in no filter.
    """
    shards = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = _built(codes, repeated, name)
    tidy(made.sparkSession)
    runs: list[list[int]] = [[0, -1, 0]]
    for row in made.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).orderBy("shard").collect():
        if runs[-1][2] and runs[-1][2] + row["n"] > limit:
            runs.append([row["shard"], row["shard"], 0])
        runs[-1][1:] = row["shard"], runs[-1][2] + row["n"]
    for low, high, _ in runs:
        yield _gathered(made.filter(F.col("shard").between(low, high)), shards), low, high, len(runs) == 1
    dropped(made)


def shard_of(code: str, shards: int) -> Column:
    """The shard of a code in a bigint column, whose bits are unsigned."""
    return F.pmod(F.pmod(F.col(code), F.lit(shards)) + F.when(F.col(code) < 0, (1 << 64) % shards).otherwise(0), F.lit(shards))


def code_batch(codes: np.ndarray, twice: np.ndarray, shards: int) -> pa.RecordBatch:
    """Rows for sharded()."""
    return pa.RecordBatch.from_arrays(
        [pa.array((codes % np.uint64(shards)).astype(np.int32)), pa.array(codes.view(np.int64)), pa.array(twice)], names=["shard", "code", "twice"]
    )


CODES = "shard int, code bigint, twice boolean"
