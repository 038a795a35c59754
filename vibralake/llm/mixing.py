"""Mixing sources to target weights by soft membership.

1. A classifier learns domains from a labelled table: multinomial naive Bayes over hashed words, its
   counts summed over all labelled rows, sharded by domain and block of buckets. Any number of
   domains is fitted: the more there are, the fewer buckets each has, so the model's size is bounded
   until there are thousands.
2. Every document gets its number of tokens (words) and the posterior of each domain. A document
   belongs to all domains in part, so domains have expected token totals. What a posterior has below
   1e-9 is cut, and the rest is kept as pairs (domain, probability).
3. Rates r >= least rate, one for each document, are fitted so that the expected totals under the
   rates match the targets: accelerated projected gradient on

       1/2 sum_k (T_k(r)/N - w_k)^2 / c_k + ridge/2 sum_d n_d/N (r_d - 1)^2,  T_k(r) = sum_d r_d n_d p_dk.

   c_k is the larger of the domain's share and its target, so a domain's rates don't depend on how
   much of the corpus it is: with target 0, documents that are all its own get ridge/(1 + ridge).
   A document's rate follows from its posterior and the gradients of all steps so far, which are
   a few numbers a step. So a step is one pass over (tokens, posterior) that replays steps and sums
   the totals; a lost executor loses nothing. Documents are packed into blocks for that, a row for
   thousands of them, and every REPLAYED steps the blocks are written again with the rates reached,
   so that the passes' work grows with the steps and not with their square. The length of
   a step comes from the domains' shares, which bound the curvature: the scaled matrix of moments has
   no eigenvalue above its largest row sum.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vibralake.llm.bloom import mixed
from vibralake.llm.shared import chunks, clean_columns, ship, staged
from vibralake.llm.substring import word_hashes

#: Buckets of hashed words at most and at least, entries of the model at most (where buckets can fall), buckets
#: of a block, additive smoothing, temperature of the posteriors, the least probability that is kept.
BUCKETS, LEAST_BUCKETS, ENTRIES, BLOCK, SMOOTHING, TEMPERATURE, LEAST_POSTERIOR = 1 << 16, 1 << 10, 1 << 21, 1 << 10, 0.1, 4.0, 1e-9
#: Weight of staying at rate 1; steps at most (a step takes 1 - sqrt(ridge) of the error or less, so the fit ends long before);
#: the largest change of a domain's total by a step, as a part of its share or target, that ends the fit.
RIDGE, STEPS, TOLERANCE = 2e-3, 1000, 2e-6
#: Steps that a pass replays at most; then the rates reached are written with the blocks.
REPLAYED = 16
#: Gap of a domain's total, as a part of its share or target, from which on a warning is given.
MISSED = 0.02
#: Entries of counts that wait at least before they are summed.
WAITING = 1 << 19
#: Labelled identifiers that are broadcast at most; with more, the labelled table is joined by shuffle.
LABELLED_ROWS = 1_000_000
_PARTS = np.zeros(256, bool)
_PARTS[:128] = [not chr(b).isalnum() for b in range(128)]


def buckets_of(domains: int) -> int:
    """How many buckets each of so many domains has: a power of two."""
    return max(LEAST_BUCKETS, min(BUCKETS, 1 << max(ENTRIES // max(domains, 1), 1).bit_length() - 1))


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Buckets of words and how many each text has, for words as they are and in lower case without punctuation; words of each text."""
    plain, counts = word_hashes(texts)
    bare, more = word_hashes(texts, fold=True, separator=_PARTS)
    bucket = lambda code: (code & np.uint64(buckets - 1)).astype(np.int64)
    return [(bucket(plain), counts), (bucket(mixed(bare, 41)), more)], counts


def _domain(labels: DataFrame, docs: DataFrame, language: str) -> DataFrame:
    """Labelled identifiers with their domain, language/class: doc, domain. Conflicting labels count as the worse."""
    clean = clean_columns(labels, doc_id="bigint", quality="int", toxic="int").filter("doc_id is not null")
    every = clean.groupBy(F.col("doc_id").alias("doc")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    kind = F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "good").otherwise("poor")
    known = docs.select(F.col("doc"), F.coalesce(F.col(language), F.lit("")).alias("language"))
    return every.join(known, "doc").groupBy("doc").agg(F.min("language").alias("language"), F.first(kind).alias("kind")).select("doc", F.concat_ws("/", "language", "kind").alias("domain"))


class Model:
    """Log-probabilities of buckets by domain, and log-priors."""

    def __init__(self, counts: np.ndarray, rows: np.ndarray) -> None:
        self.buckets = counts.shape[1]
        self.bucket = np.empty(counts.shape, np.float32)
        for k, row in enumerate(counts):
            self.bucket[k] = np.log((row + SMOOTHING) / (row.sum() + SMOOTHING * self.buckets))
        self.prior = np.log((rows + 1) / (rows + 1).sum())

    def posteriors(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        logits = np.repeat(self.prior[None, :], len(sets[0][1]), axis=0)
        for code, counts in sets:
            some = np.flatnonzero(counts)
            if len(some):
                first = (np.cumsum(counts) - counts)[some]
                for k in range(len(self.prior)):
                    logits[some, k] += np.add.reduceat(self.bucket[k][code], first, dtype=np.float64) / TEMPERATURE
        made = np.exp(logits - logits.max(axis=1, keepdims=True))
        made /= made.sum(axis=1, keepdims=True)
        made[made < LEAST_POSTERIOR] = 0
        return made / made.sum(axis=1, keepdims=True)


def fit_classifier(labelled: DataFrame, domains: list[str]) -> Model:
    """From rows (number of the domain, text). A task gives what it counted by domain and block, so no task of the sum holds a domain."""
    size, buckets = len(domains), buckets_of(len(domains))
    block = min(BLOCK, buckets)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(size, np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]  # what is summed already comes first
        waiting = 0
        for batch in chunks(batches):
            at = batch.column(0).to_numpy().astype(np.int64)
            fresh = [np.repeat(at, counts) * buckets + code_ for code_, counts in features(batch.column(1), buckets)[0]]
            found.append(np.unique(np.concatenate(fresh), return_counts=True))
            rows += np.bincount(at, minlength=size)
            waiting += len(found[-1][0])
            if waiting > max(WAITING, len(found[0][0])):
                found, waiting = [_summed(found)], 0
        code, many = _summed(found)
        heads = np.flatnonzero(np.concatenate([[True], code[1:] // block != code[:-1] // block])) if len(code) else np.zeros(0, np.int64)
        packed = zip(np.split(code % block, heads[1:]), np.split(many, heads[1:]), strict=True) if len(code) else ()
        made = [np.concatenate([c, n]).tobytes() for c, n in packed]
        seen = np.flatnonzero(rows)
        yield _sums([*(code[heads] // block).tolist(), *(-1 - seen).tolist()], [*made, *[rows[k].tobytes() for k in seen]])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks from 0 on have counts, and block -1 - k the number of rows of domain k."""
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs = np.frombuffer(raw, np.int64)
                if at < 0:
                    total[at] = total.get(at, 0) + pairs
                else:
                    held = total.setdefault(at, np.zeros(block, np.int64))
                    held[pairs[: len(pairs) // 2]] += pairs[len(pairs) // 2 :]
        yield _sums(list(total), [x.tobytes() for x in total.values()])

    schema = "block int, counts binary"
    counts, rows = np.zeros((size, buckets), np.int64), np.zeros(size, np.int64)
    flat = counts.reshape(-1)
    for row in labelled.mapInArrow(local, schema).repartition("block").mapInArrow(added, schema).toLocalIterator():  # at most a row a block
        if row["block"] < 0:
            rows[-1 - row["block"]] = np.frombuffer(row["counts"], np.int64)[0]
        else:
            flat[row["block"] * block : (row["block"] + 1) * block] = np.frombuffer(row["counts"], np.int64)
    return Model(counts, rows)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    code, many = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(code, kind="stable")
    code, many = code[order], many[order]
    heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[heads], np.add.reduceat(many, heads) if len(heads) else many


def _sums(blocks: list[int], counts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(counts, pa.binary())], names=["block", "counts"])


_PAIR = np.dtype([("domain", "<i4"), ("p", "<f8")])


def packed_posteriors(p: np.ndarray) -> list[bytes]:
    """Each row's probabilities above 0 with their domains."""
    row, column = np.nonzero(p)
    pairs = np.empty(len(row), _PAIR)
    pairs["domain"], pairs["p"] = column, p[row, column]
    ends = np.cumsum(np.bincount(row, minlength=len(p)))
    return [x.tobytes() for x in np.split(pairs, ends[:-1])] if len(p) else []


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's pairs begin, with the end of the last one's, and all pairs."""
    packed = packed.cast(pa.binary())
    _, offsets, data = packed.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(packed) + 1, packed.offset * 4)
    pairs = np.frombuffer(data, _PAIR, (int(offsets[-1]) - int(offsets[0])) // _PAIR.itemsize, int(offsets[0]))
    return (offsets - offsets[0]) // _PAIR.itemsize, pairs


def _dense(ends: np.ndarray, pairs: np.ndarray, domains: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where a piece of the rows begins, and its posteriors as a matrix of bounded size."""
    step = max(1, (1 << 20) // max(domains, 1))
    for start in range(0, len(ends) - 1, step):
        at = ends[start : start + step + 1]
        p = np.zeros((len(at) - 1, domains))
        here = pairs[at[0] : at[-1]]
        p[np.repeat(np.arange(len(p)), np.diff(at)), here["domain"]] = here["p"]
        yield start, p


def dense_posteriors(packed: pa.Array, domains: int) -> Iterator[tuple[int, np.ndarray]]:
    """As _dense(), from the rows' packed posteriors."""
    if len(packed):
        yield from _dense(*_unpacked(packed), domains)


@dataclass(frozen=True)
class Bounds:
    """The least rate; and, if domains are wanted or not by their targets, 1 at least for documents likeliest in a wanted one, 0 for others."""

    least: float = 0.0
    wanted: tuple[bool, ...] = ()

    def of(self, posterior: np.ndarray) -> tuple[np.ndarray | float, np.ndarray | float]:
        if not self.wanted:
            return self.least, np.inf
        good = np.array(self.wanted)[posterior.argmax(axis=1)]
        return np.where(good, max(1.0, self.least), 0.0), np.where(good, np.inf, 0.0)


def _walked(posterior: np.ndarray, gaps: list[np.ndarray], steps: list[float], size: float, ridge: float, bounds: Bounds, begin: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From rates of 1, or from a point and rates reached before: the next point, the rates, and how far the last step took them."""
    low, high = bounds.of(posterior)
    look, rate = begin if begin else 2 * (np.clip(np.ones(len(posterior)), low, high),)
    moved = np.zeros(len(posterior))
    for gap, momentum in zip(gaps, steps, strict=True):
        new = np.clip(look - size * (posterior @ gap + ridge * (look - 1)), low, high)
        moved = np.abs(new - look)
        look, rate = new + momentum * (new - rate), new
    return look, rate, moved


def replayed(posterior: np.ndarray, gaps: list[np.ndarray], steps: list[float], size: float, ridge: float, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps that the gradients in gaps and the momenta in steps describe, and how far the last step took them."""
    return _walked(posterior, gaps, steps, size, ridge, bounds)[1:]


#: A block holds the documents of one Arrow batch: tokens, where their pairs begin, the pairs; the point and rates reached (none before the first step).
_BLOCKS = "tokens binary, ends binary, pairs binary, look binary, rate binary"


def _binary(rows: list[tuple[bytes, ...]], names: str) -> pa.RecordBatch:
    columns = [pa.array([row[i] for row in rows], pa.binary()) for i in range(len(names.split()))]
    return pa.RecordBatch.from_arrays(columns, names=names.split())


def _blocks(members: DataFrame) -> DataFrame:
    """Blocks of members (tokens, posterior packed), staged."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ends, pairs = _unpacked(batch.column(1))
                tokens = batch.column(0).to_numpy().astype(np.float64)
                yield _binary([(tokens.tobytes(), ends.astype(np.int64).tobytes(), pairs.tobytes(), b"", b"")], "tokens ends pairs look rate")

    return staged(members.mapInArrow(packed, _BLOCKS), "blocks")


def _pieces(batch: pa.RecordBatch, domains: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray] | None]]:
    """For the blocks of a batch: number of the block in it, tokens, posteriors as a matrix, point and rates."""
    for i, (tokens, ends, pairs, look, rate) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
        tokens, look, rate = (np.frombuffer(x) for x in (tokens, look, rate))
        for start, p in _dense(np.frombuffer(ends, np.int64), np.frombuffer(pairs, _PAIR), domains):
            here = slice(start, start + len(p))
            yield i, tokens[here], p, (look[here], rate[here]) if len(look) else None


def _added(parts: DataFrame, tasks: int, length: int) -> np.ndarray:
    """The sum of rows of doubles, one from each of so many tasks: summed by about as many tasks as the root of that, then here."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(length)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                held += np.frombuffer(row)
        yield _binary([(held.tobytes(),)], "v")

    some = parts.repartition(max(1, math.isqrt(tasks))).mapInArrow(add, "v binary")
    return sum((np.frombuffer(r["v"]) for r in some.collect()), np.zeros(length))


def fit_rates(members: DataFrame, shares: np.ndarray, targets: np.ndarray, total: float, ridge: float = RIDGE, bounds: Bounds = Bounds(), most_steps: int = STEPS, tolerance: float = TOLERANCE, scale: np.ndarray | None = None):
    """For members (tokens, posterior packed), what replayed() needs: gaps, momenta, size of a step; and the fitted shares.

    shares are those of the domains at rates of 1; scale holds the c_k by which residuals are divided
    (left out: 1); the gaps returned are divided by them.
    """
    domains = len(shares)
    scale = np.ones(domains) if scale is None else scale

    blocks = _blocks(members)
    tasks = blocks.rdd.getNumPartitions()

    def totals(done: int) -> tuple[np.ndarray, np.ndarray]:
        """Each domain's share under the rates, and how far the last step took it; the blocks hold the rates after so many steps."""
        past, momenta = gaps[done:], steps[done:]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, domains))
            for batch in batches:
                for _, tokens, p, begin in _pieces(batch, domains):
                    sums += (tokens * np.stack(_walked(p, past, momenta, size, ridge, bounds, begin)[1:])) @ p
            yield _binary([(sums.tobytes(),)], "v")

        shares, moved = _added(blocks.mapInArrow(run, "v binary"), tasks, 2 * domains).reshape(2, domains) / max(total, 1.0)
        return shares, moved

    def written(done: int) -> DataFrame:
        """The blocks with the rates after all steps so far."""
        past, momenta = gaps[done:], steps[done:]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                reached: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
                for i, _, p, begin in _pieces(batch, domains):
                    reached[i].append(np.stack(_walked(p, past, momenta, size, ridge, bounds, begin)[:2]))
                rows = [np.concatenate(x, axis=1) for x in reached]
                made = _binary([(x[0].tobytes(), x[1].tobytes()) for x in rows], "look rate")
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made.columns], names=batch.schema.names)

        return staged(blocks.mapInArrow(run, _BLOCKS), "blocks")

    steepest = float((shares / scale).max(initial=0.0))
    size = 1.0 / (steepest + ridge) if steepest + ridge > 0 else 1.0
    gaps: list[np.ndarray] = []
    steps: list[float] = []
    done = 0
    before = now = totals(done)[0]
    slow = (ridge * size) ** 0.5
    t, momentum, most = 1.0, 0.0, (1 - slow) / (1 + slow)  # with this bound the error falls by a fixed part in a step
    for _ in range(most_steps):
        look = now + momentum * (now - before)  # totals are linear in the rates
        gaps.append((look - targets) / scale)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, t = min((t - 1) / after, most), after
        steps.append(momentum)
        before, (now, moved) = now, totals(done)
        if (moved / scale).max(initial=0.0) <= tolerance:
            break
        if len(steps) - done >= REPLAYED:
            blocks, done = written(done), len(steps)
    else:
        if tolerance:
            warnings.warn(f"rates still move by {(moved / scale).max():.1e} of a domain after {most_steps} steps", stacklevel=2)
    return gaps, steps, size, now


def uses_of(rate: Column, *key: Column | str) -> Column:
    """A whole number of uses whose expectation is the rate: its floor, and one more by a draw that depends on key alone."""
    draw = F.pmod(F.xxhash64(F.lit(77), *key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def raised(shares: dict[str, float], power: float) -> dict[str, float]:
    """Target totals: good domains smaller than the largest get as much more as brings the ratio of totals to its power; others get none."""
    good = {k: v for k, v in shares.items() if k.endswith("/good") and v > 0}
    top = max(good.values(), default=0.0)
    return {k: top * (good[k] / top) ** power if k in good else 0.0 for k in shares}


def tempered(shares: dict[str, float], power: float) -> dict[str, float]:
    """Target totals: the good domains share the expected tokens of the good, in proportion to a power of their own; others get none."""
    good = {k: v for k, v in shares.items() if k.endswith("/good") and v > 0}
    weight = {k: v**power for k, v in good.items()}
    return {k: weight[k] / sum(weight.values()) * sum(good.values()) if k in good else 0.0 for k in shares}


#: Columns that the operator makes.
RESULTS = ("n_tokens", "domain", "posterior", "rate")


def mix(
    df: DataFrame,
    labels: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    columns: tuple[str, ...] = (),
    power: float = 0.7,
    least_rate: float = 0.0,
    labelled_rows: int = LABELLED_ROWS,
    targets: dict[str, float] | None = None,
    with_text: bool = True,
    report: dict[str, tuple[float, float, float]] | None = None,
    keep_wanted: bool = False,
    aim: Callable[[dict[str, float]], dict[str, float]] | None = None,
) -> DataFrame:
    """One row per row of df: identifier, columns, text (unless with_text is off), n_tokens, domain, posterior, rate.

    Domains are language/class, with class toxic, good or poor by the labels. targets gives shares
    of the tokens by domain (left out: 0), or aim makes them from the domains' own shares; without
    either, the good domains share what the good have, in proportion to a power of their expected
    tokens, and the others get none. There may be any number of domains. domain is the likeliest one
    and posterior its probability; report is filled with each domain's share, target and the share
    that the rates reach, all of the tokens beforehand; a domain that misses its target by more than
    MISSED of it (or of its share, if that is larger) is warned of. rate is how many times the document is to be used;
    keep_wanted holds it at 1 or more for documents whose likeliest domain has a target above 0, and
    at 0 for the others. Without
    any labelled row of df there are no domains: domain and posterior are null, and rates 1. A null
    text counts as empty and has no tokens: its domain is the likeliest beforehand. A text of any length is judged whole. Repeated rows
    get equal rates; an empty table gives none; columns that aren't named are left out, as are columns named like the results.
    """
    spark = ship(df.sparkSession)
    carried = {f"__{i}": c for i, c in enumerate(columns) if c.lower() not in RESULTS}
    work = df.select(
        F.col(f"`{identifier}`").cast("bigint").alias("doc"),
        F.col(f"`{language}`").cast("string").alias("language"),
        *[F.col(f"`{c}`").alias(a) for a, c in carried.items()],
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    known = staged(_domain(labels, work, "language"), "domains")
    domains = [r["domain"] for r in known.select("domain").distinct().orderBy("domain").toLocalIterator()]
    named = [F.col(a).alias(c) for a, c in carried.items()]
    body = [F.col("text").alias(text)] if with_text else []
    if not domains:
        n = F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("bigint")
        nothing = [F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("posterior"), F.lit(1.0).alias("rate")]
        return work.select(F.col("doc").alias(identifier), *named, *body, n.alias("n_tokens"), *nothing)

    order = spark.createDataFrame(list(enumerate(domains)), "number int, domain string")
    numbered = known.join(F.broadcast(order), "domain").select("doc", "number")  # a row a domain
    if known.count() <= labelled_rows:
        numbered = F.broadcast(numbered)
    model = spark.sparkContext.broadcast(fit_classifier(work.select("doc", "text").join(numbered, "doc").select("number", "text"), domains))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets, words = features(batch.column(batch.num_columns - 1), model.value.buckets)
            made = [batch.column(batch.num_columns - 1)] if with_text else []
            p = pa.array(packed_posteriors(model.value.posteriors(sets)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made, pa.array(words), p], names=[*batch.schema.names[: len(batch.columns) - 1 + len(made)], "tokens", "posterior"])

    slim = ", ".join(f"`{c}` {t}" for c, t in (work.dtypes if with_text else work.dtypes[:-1]))
    rows = staged(work.mapInArrow(judged, f"{slim}, tokens bigint, posterior binary"), "members")
    members = rows.select("tokens", "posterior")
    size = len(domains)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size)
        for batch in batches:
            tokens = batch.column(0).to_numpy()
            for start, p in dense_posteriors(batch.column(1), size):
                held += tokens[start : start + len(p)] @ p
        yield _binary([(held.tobytes(),)], "v")

    expected = _added(members.mapInArrow(sums, "v binary"), members.rdd.getNumPartitions(), size)
    total = float(expected.sum())
    shares = dict(zip(domains, (expected / max(total, 1.0)).tolist(), strict=True))
    wanted = targets if targets is not None else aim(shares) if aim else tempered(shares, power)
    aims = np.array([wanted.get(k, 0.0) for k in domains])
    scale = np.maximum(expected / max(total, 1.0), aims)
    scale[scale <= 0] = 1.0
    bounds = Bounds(least_rate, tuple((aims > 0).tolist()) if keep_wanted else ())
    gaps, steps, step, reached = fit_rates(members, expected / max(total, 1.0), aims, total, bounds=bounds, scale=scale)
    missed = np.flatnonzero(np.abs(reached - aims) > MISSED * scale)
    if len(missed):
        worst = missed[np.argmax((np.abs(reached - aims) / scale)[missed])]
        warnings.warn(f"{len(missed)} of {size} domains miss their target by over {MISSED:.0%}; {domains[worst]} reaches {reached[worst]:.3g} of {aims[worst]:.3g}", stacklevel=2)
    if report is not None:
        report.update({k: (shares[k], float(aims[i]), float(reached[i])) for i, k in enumerate(domains)})

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From the staged posteriors."""
        for batch in chunks(batches) if with_text else batches:
            if not batch.num_rows:
                continue
            best, chance, rate = [], [], []
            for _, p in dense_posteriors(batch.column(batch.num_columns - 1), size):
                top = p.argmax(axis=1)
                best += [domains[k] for k in top.tolist()]
                chance.append(p[np.arange(len(p)), top])
                rate.append(replayed(p, gaps, steps, step, RIDGE, bounds)[0])
            made = [batch.column(batch.num_columns - 2), pa.array(best, pa.string()), pa.array(np.concatenate(chance)), pa.array(np.concatenate(rate))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*batch.schema.names[:-2], "n_tokens", "domain", "posterior", "rate"])

    out = rows.mapInArrow(rated, slim + ", n_tokens bigint, domain string, posterior double, rate double")
    return out.select(F.col("doc").alias(identifier), *named, *body, "n_tokens", "domain", "posterior", "rate")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its likeliest domain and its rate."""
    return mix(docs, labels, with_text=False).select("doc_id", "n_tokens", "domain", "posterior", "rate")
