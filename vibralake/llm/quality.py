"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes of UTF-8: n-grams of ORDER symbols, packed into 64-bit integers of 8 bits a
symbol, so no two characters share a symbol in any script. (Word n-grams of a corpus hardly repeat,
so their join would move more than the text.)

1. Trusted rows are split by a hash of their identifier: most train, the rest calibrate.
2. Counts of the highest order are summed over all training rows, sharded by n-gram; each lower
   order counts distinct left extensions. Discounts come from the counts of counts, back-off
   weights from sums by context. All of these are sharded aggregates and joins.
3. The distinct n-grams of the documents to score are joined with the counts, order by order, which
   gives log-probabilities; unseen n-grams back off. They are broadcast within a bound of their
   number; beyond it, every document's n-grams are joined and summed by document.
4. A document's perplexity is per symbol, shrunk towards its language's trusted mean by a number of
   prior symbols, so that short texts aren't judged by noise. Documents above a high quantile of
   their language's calibration rows are rejected.

Log-probabilities are integers of 2**-24 and counts are integers, so sums don't depend on their
order: results are equal over all partitionings, and on both ways of step 3. Quantiles are taken
over steps of log-perplexity of 2**-16, and a document is judged by its step.

Languages differ in their calibration rows from millions to one. What is compared are differences
from a language's mean; its quantile of them is mixed with that of all calibration rows, which
weighs as much as SHRINK rows, and its mean with that of all, which weighs as much as SHRINK_SYMBOLS
symbols. There is no least number of rows. A language without any calibration row has no threshold,
and its documents are kept: nothing is known against them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vibralake.llm.bloom import mixed
from vibralake.llm.shared import chunks, clean_columns, row_keys, ship, staged

ORDER, BITS = 5, 8
#: Quantile of the trusted rows' perplexity, share of trusted rows that calibrate (one in so many),
#: symbols of prior, rows and symbols that the whole corpus weighs in a language's quantile and mean.
QUANTILE, FOLDS, PRIOR, SHRINK, SHRINK_SYMBOLS = 0.995, 5, 60, 30, 2000
#: Units of a log-probability and of a step of log-perplexity.
UNIT, STEP = 1 << 24, 1 << 16
#: Bytes of text handled at once: a symbol takes some ten times eight bytes.
CHUNK = 1 << 19
#: Symbols looked up at once.
PIECE = 1 << 18
#: Bounds of what is broadcast: scored n-grams, trusted identifiers.
SCORED_GRAMS, TRUSTED_ROWS = 3_000_000, 1_000_000
#: Symbols: bytes stand for themselves (digits as 0, white space as a blank); 0 is the start of a text.
_SYMBOL = np.arange(256, dtype=np.uint8)
_SYMBOL[0] = 1
_SYMBOL[0x30:0x3A] = 0x30
_SYMBOL[0x09:0x0E] = 0x20


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol of the texts, and the number of symbols of each text."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    sizes = np.diff(ends)
    if ends[0] == ends[-1]:
        return np.zeros(0, np.int64), sizes
    symbols = _SYMBOL[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]]
    inside = np.ones(len(symbols) + (ORDER - 1) * len(sizes), bool)  # each text behind ORDER - 1 starts
    begins = ends[:-1] - ends[0] + (ORDER - 1) * np.arange(len(sizes))
    for i in range(ORDER - 1):
        inside[begins + i] = False
    padded = np.zeros(len(inside), np.uint8)
    padded[inside] = symbols
    code = np.zeros(len(padded), np.int64)
    for back in range(ORDER - 1, -1, -1):
        code <<= BITS
        code[back:] |= padded[: len(padded) - back]
    return code[inside], sizes


def _low(order: int) -> int:
    return (1 << (BITS * order)) - 1


def _collected(batches: Iterator[pa.RecordBatch], counted: bool, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a task's texts (the last column), with counts; given out whenever limit is reached."""
    code, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    give = lambda: pa.RecordBatch.from_arrays([pa.array(code), pa.array(many)], names=["gram", "n"])
    for batch in chunks(batches, limit=CHUNK):
        if counted:
            fresh, n = np.unique(grams(batch.column(batch.num_columns - 1))[0], return_counts=True)
            both = np.concatenate([code, fresh])
            code, back = np.unique(both, return_inverse=True)
            many = np.bincount(back, weights=np.concatenate([many, n]), minlength=len(code)).astype(np.int64)
        else:
            code = np.unique(np.concatenate([code, np.unique(grams(batch.column(batch.num_columns - 1))[0], sorted=False)]))
            many = np.ones(len(code), np.int64)
        if len(code) > limit:
            yield give()
            code, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield give()


class Lookup:
    """Values by 64-bit key: open addressing, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.mask = (1 << max(4, (len(keys) * 3 // 2).bit_length())) - 1
        self.keys, self.values = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int32)
        at, left = self._first(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == -1
            self.keys[at[left[free]]] = keys[left[free]]
            done = self.keys[at[left]] == keys[left]
            self.values[at[left[done]]] = values[left[done]]
            left = left[~done]
            at[left] = (at[left] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64), 3) & np.uint64(self.mask)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        parts = [self._of(keys[i : i + PIECE]) for i in range(0, len(keys), PIECE)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def _of(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        missing = np.flatnonzero(self.keys[at] != keys)
        while len(missing):
            at[missing] = (at[missing] + 1) & self.mask
            missing = missing[self.keys[at[missing]] != keys[missing]]
        return self.values[at]


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4."""
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    made = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else float(i + 1) for i in range(3)]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(made)]


def train(texts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1 to ORDER: (gram, part) with the discounted share of each n-gram, (context, weight) of back-off."""
    counts = staged(
        texts.mapInArrow(lambda b: _collected(b, True), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "kn-counts"
    )
    orders = [counts]
    for k in range(ORDER - 1, 0, -1):
        orders.append(staged(orders[-1].groupBy(F.col("gram").bitwiseAND(_low(k)).alias("gram")).agg(F.count("*").alias("n")), "kn-counts"))
    model = []
    for table in reversed(orders):
        cut = discounts(list(table.agg(*[F.count_if(F.col("n") == i) for i in range(1, 5)]).first()))
        of = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        context = F.shiftright("gram", BITS).alias("context")
        sums = table.groupBy(context).agg(F.sum("n").alias("total"), *[F.count_if(c).alias(f"n{i}") for i, c in enumerate((F.col("n") == 1, F.col("n") == 2, F.col("n") > 2))])
        taken = sum((F.col(f"n{i}") * d for i, d in enumerate(cut)), F.lit(0.0))
        parts = table.select("gram", context, (F.col("n") - of).alias("left")).join(sums, "context").select("gram", (F.col("left") / F.col("total")).alias("part"))
        model.append((parts, sums.select("context", (taken / F.col("total")).alias("weight"))))
    return model


def score(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, logp in units) for the distinct n-grams in wanted: sharded joins with the counts, from order 1 upwards."""
    levels = [staged(wanted.select("gram").distinct(), "kn-wanted")]
    for k in range(ORDER - 1, 0, -1):
        levels.append(levels[-1].select(F.col("gram").bitwiseAND(_low(k)).alias("gram")).distinct())
    below = None
    for k, (grams_of, (parts, weights)) in enumerate(zip(reversed(levels), model, strict=True), 1):
        rows = grams_of.select("gram", F.shiftright("gram", BITS).alias("context"), F.col("gram").bitwiseAND(_low(k - 1)).alias("suffix"))
        rows = rows.join(parts, "gram", "left").join(weights, "context", "left")
        lower = F.lit(1.0 / (1 << BITS))
        if below is not None:
            rows, lower = rows.join(below, "suffix"), F.col("lower")
        p = F.coalesce("part", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * lower
        below = staged(rows.select(F.col("gram").alias("suffix"), p.alias("lower")), "kn-order")
    return below.select(F.col("suffix").alias("gram"), F.round(F.log("lower") * UNIT).cast("int").alias("logp"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["grams", "logps"])


def perplexities(work: DataFrame, scored: DataFrame, limit: int = SCORED_GRAMS) -> DataFrame:
    """work (with key_a, key_b and, as last column, text) with n_symbols and loss, the negative log-likelihood in units."""
    fields = ", ".join(f"`{c}` {t}" for c, t in work.dtypes)
    if scored.count() <= limit:
        parts = scored.mapInArrow(_packed, "grams binary, logps binary").collect()  # a row a batch: a tenth of the driver's memory that single rows take
        table = [np.frombuffer(b"".join(bytes(p[c]) for p in parts), kind) for c, kind in (("grams", np.int64), ("logps", np.int32))]
        del parts
        shared = work.sparkSession.sparkContext.broadcast(tuple(table))
        made: list[Lookup] = []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(Lookup(*shared.value))
            for batch in chunks(batches, limit=CHUNK):
                code, sizes = grams(batch.column(batch.num_columns - 1))
                sums = np.concatenate([[0], np.cumsum(made[0].of(code), dtype=np.int64)])
                ends = np.cumsum(sizes)
                loss = sums[ends - sizes] - sums[ends]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), pa.array(loss)], names=[*batch.schema.names, "n_symbols", "loss"])

        return work.mapInArrow(run, fields + ", n_symbols bigint, loss bigint")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=CHUNK):
            code, sizes = grams(batch.column(2))
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((code, row))
            row, code = row[order], code[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
            heads = np.flatnonzero(fresh)
            keys = [pa.array(batch.column(i).to_numpy()[row[heads]]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(code[heads]), pa.array(np.diff(np.append(heads, len(row))))], names=["key_a", "key_b", "gram", "n"])

    keyed = work.select("key_a", "key_b", "text").dropDuplicates(["key_a", "key_b"])
    rows = keyed.mapInArrow(spread, "key_a bigint, key_b bigint, gram bigint, n bigint").join(scored, "gram")
    sums = rows.groupBy("key_a", "key_b").agg(F.sum("n").alias("n_symbols"), (-F.sum(F.col("n") * F.col("logp"))).alias("loss"))
    return work.join(sums, ["key_a", "key_b"], "left").select(*work.columns, F.coalesce("n_symbols", F.lit(0)).alias("n_symbols"), F.coalesce("loss", F.lit(0)).alias("loss"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Identifiers whose labels all say good and none says toxic: doc."""
    clean = clean_columns(labels, doc_id="bigint", quality="int", toxic="int").filter("doc_id is not null")
    every = clean.groupBy(F.col("doc_id").alias("doc")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return every.filter("good = 1 and toxic = 0").select("doc")


def quantile_of(tally: DataFrame, keys: list[str], quantile: float) -> DataFrame:
    """keys, step, rows: the least step that this part of the rows doesn't pass, and their number, from (keys, step, rows)."""
    before = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    counted = tally.withColumns({"total": F.sum("rows").over(before), "upto": F.sum("rows").over(before.orderBy("step"))})
    return counted.filter(F.col("upto") >= F.lit(quantile) * F.col("total")).groupBy(*keys).agg(F.min("step").alias("step"), F.first("total").alias("rows")).filter("step is not null")


#: Columns that the operator makes.
RESULTS = ("n_symbols", "perplexity", "threshold", "kept")


def classify(
    df: DataFrame,
    labels: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    columns: tuple[str, ...] = (),
    quantile: float = QUANTILE,
    scored_grams: int = SCORED_GRAMS,
    trusted_rows: int = TRUSTED_ROWS,
) -> DataFrame:
    """One row per row of df: identifier, columns, text, n_symbols, perplexity, threshold, kept.

    Trusted are rows of df whose identifier is labelled good and not toxic. A row is kept unless its
    perplexity is above its language's threshold (null is a language of its own), which is null, and
    the row kept, without any calibration row of the language; a null or empty text has no
    perplexity and is kept; one of any length is scored whole. Columns that aren't named are left
    out, as are columns named like the results; repeated rows give equal results; an empty table
    gives none.
    """
    ship(df.sparkSession)
    carried = {f"__{i}": c for i, c in enumerate(columns) if c.lower() not in RESULTS}
    work = df.select(
        F.col(f"`{identifier}`").cast("bigint").alias("doc"),
        F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")).alias("language"),
        *[F.col(f"`{c}`").alias(a) for a, c in carried.items()],
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    ids = staged(trusted_ids(labels), "trusted")
    if ids.count() <= trusted_rows:
        ids = F.broadcast(ids)
    trusted = work.select("doc", "language", "text").join(ids, "doc")
    fold = F.pmod(F.xxhash64("doc"), F.lit(FOLDS))
    model = train(trusted.filter(fold != 0).select("text"))
    wanted = work.select("text").mapInArrow(lambda b: _collected(b, False), "gram bigint, n bigint")
    scored = staged(score(wanted, model), "kn-scores")

    keyed = lambda d: d.select(*row_keys("doc", "text"), *[c for c in d.columns if c != "text"], "text")
    held = staged(perplexities(keyed(trusted.filter((fold == 0) & (F.length("text") > 0))), scored, scored_grams).select("language", "n_symbols", "loss"), "calibration")
    pooled = held.agg(F.sum("loss").alias("loss"), F.sum("n_symbols").alias("n")).first()
    mean_all = pooled["loss"] / pooled["n"] if pooled["n"] else 0.0
    means = held.groupBy("language").agg(((F.sum("loss") + F.lit(SHRINK_SYMBOLS * mean_all)) / (F.sum("n_symbols") + SHRINK_SYMBOLS)).alias("mean"))
    # log-perplexity in steps, as the difference from the language's mean
    shrunk = (F.col("loss") + PRIOR * F.col("mean")) / (F.col("n_symbols") + PRIOR)
    step = F.round((shrunk - F.col("mean")) / (UNIT / STEP)).cast("bigint")
    tally = staged(held.join(means, "language").groupBy("language", step.alias("step")).agg(F.count("*").alias("rows")), "tally")  # at most as many steps as perplexities differ by
    every = quantile_of(tally.groupBy("step").agg(F.sum("rows").alias("rows")), [], quantile).first()
    share = F.col("rows") / (F.col("rows") + SHRINK)
    limit = F.round(share * F.col("step") + (1 - share) * F.lit(every["step"] if every else 0)).cast("bigint")
    own = quantile_of(tally, ["language"], quantile).select("language", limit.alias("limit"))
    rules = staged(own.join(means, "language"), "rules")  # a row a language; joined by broadcast if Spark's own bound allows it
    judged = perplexities(keyed(work), scored, scored_grams).join(rules, "language", "left")
    judged = judged.withColumns({"step": step, "mean": F.coalesce("mean", F.lit(mean_all))})
    judged = judged.withColumns({"perplexity": F.when(F.col("n_symbols") > 0, F.exp(shrunk / UNIT)), "threshold": F.exp(F.col("mean") / UNIT + F.col("limit") / STEP)})
    return judged.select(
        F.col("doc").alias(identifier),
        *[F.col(a).alias(c) for a, c in carried.items()],
        F.col("text").alias(text),
        "n_symbols",
        "perplexity",
        "threshold",
        F.coalesce(F.col("perplexity").isNull() | (F.col("step") <= F.col("limit")), F.lit(True)).alias("kept"),
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its perplexity and the decision."""
    return classify(docs, labels).select("doc_id", "n_symbols", "perplexity", "threshold", "kept")
