"""Secret scan in DataFrame functions only.

Base patterns (assignments, access keys, hexadecimal runs) give base spans. Beyond them, maximal
runs of each character class are candidates; a window of fixed width slides over every candidate,
and the Shannon entropy of its characters follows from counts that change by one character in and
one out at each step. Windows of high entropy merge into spans; an allow list suppresses known
harmless candidates. Base spans are never suppressed.

The counts are one string with a character for each letter of the class, so a step costs two
`overlay` calls; c*log2(c) comes from a table of integers, so sums are exact and free of drift.

Nothing is quadratic in a text's length or in its matches: positions are prefix sums, taken by
doubling over whole arrays, and a candidate is cut into blocks of windows, whose counts start anew.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import clean_columns

#: The base patterns, in the order that ranks equal starts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Equal to [0-9a-f]+ of 24+ and AKIA[A-Z0-9]+ of 20+ characters: shorter runs can't hide a longer match.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

#: Character classes of the entropy scan: pattern of a candidate, alphabet, fold to lower case, threshold in bits.
WINDOW = 24
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]", "0123456789abcdef", True, 3.0),
    "entropy_base64": ("[A-Za-z0-9+/_-]", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-", False, 4.0),
}
#: Candidates that are no secrets: plain words, UUIDs, runs of one sort of digit or letter, placeholders.
ALLOW = (
    r"^[A-Za-z/_-]+$|^[0-9/_+-]+$"
    r"|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|[eE][xX][aA][mM][pP][lL][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD][eE][rR]|[cC][hH][aA][nN][gG][eE][mM][eE]"
    r"|[dD][uU][mM][mM][yY]|[xX]{6}|0123456789|[aA][bB][cC][dD][eE][fF][gG][hH]"
)
SCALE = 1_000_000
#: Windows of a block, and the character that stands for the count 0 (a count is one ASCII character).
BLOCK, FIRST = 256, 33


def weight(count: int) -> int:
    """count * log2(count), scaled to an integer."""
    return round(count * math.log2(count) * SCALE) if count > 1 else 0


def bound(window: int, bits: float) -> int:
    """Largest sum of weights at which a window still has an entropy of so many bits."""
    return math.floor((math.log2(window) - bits) * window * SCALE)


def _let(value: Column, use) -> Column:
    """Evaluate value once and use it by name."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(values: Column) -> Column:
    """Sums of values up to and including each place, by doubling: as many passes as the length has bits."""
    passes = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    step = lambda sums, k: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    return F.when(passes < 1, values).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1), values, step))


def located(text: Column, found: Column, pattern: str) -> Column:
    """Positions of found = all matches of pattern in text: array of (start, end, match), in code points.

    The text before each match is extracted only where there is a match. \\G keeps the search after
    the last match from starting again at every character.
    """
    gaps = F.regexp_extract_all(text, F.lit(rf"(?s)\G(.*?)(?:{pattern})"), F.lit(1))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    ends = running_sums(F.zip_with(gaps, found, lambda g, h: F.length(g) + F.length(h)))
    span = lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))
    return F.when(F.size(found) > 0, F.zip_with(ends, found, span)).otherwise(empty)


def _block_spans(block: Column, windows: Column, alphabet: str, fold: bool, bits: float, window: int) -> Column:
    """Merged high-entropy windows of a block: array of (start, end) inside it. The block holds the windows' characters."""
    codes = F.transform(F.split(F.lower(block) if fold else block, ""), lambda c: F.instr(F.lit(alphabet), c))
    table = F.array(*[F.lit(weight(c)) for c in range(window + 2)])
    most = bound(window, bits)
    span = "array<struct<start:int,end:int>>"
    count_of = lambda counts, code: F.ascii(F.substr(counts, code, F.lit(1))) - FIRST
    put = lambda counts, code, n: F.overlay(counts, F.char(n + FIRST), code, F.lit(1))
    g = lambda n: F.element_at(table, n + 1)

    def changed(state: Column, code: Column, by: int) -> Column:
        return _let(
            count_of(state["counts"], code),
            lambda n: F.struct(put(state["counts"], code, n + by).alias("counts"), (state["sum"] + g(n + by) - g(n)).alias("sum")),
        )

    def step(state: Column, i: Column) -> Column:
        come = changed(state["window"], F.element_at(state["codes"], i + 1), 1)
        gone = _let(come, lambda w: F.when(i >= window, changed(w, F.element_at(state["codes"], i + 1 - window), -1)).otherwise(w))

        def moved(w: Column) -> Column:
            begin, end = i - (window - 1), i + 1
            hot = (begin >= 0) & (w["sum"] <= most)
            joins = hot & (state["end"] > begin)
            opens = hot & ~(state["end"] > begin)
            closed = F.when(
                opens & (state["end"] > 0),
                F.array_append(state["out"], F.struct(state["start"].alias("start"), state["end"].alias("end"))),
            ).otherwise(state["out"])
            return F.struct(
                w.alias("window"),
                state["codes"].alias("codes"),
                F.when(opens, begin).otherwise(state["start"]).alias("start"),
                F.when(opens | joins, end).otherwise(state["end"]).alias("end"),
                closed.alias("out"),
            )

        return _let(gone, moved)

    zero = F.struct(
        F.struct(F.lit(chr(FIRST) * len(alphabet)).alias("counts"), F.lit(0).alias("sum")).alias("window"),
        codes.alias("codes"),
        F.lit(0).alias("start"),
        F.lit(0).alias("end"),
        F.array().cast(span).alias("out"),
    )
    finish = lambda s: F.when(
        s["end"] > 0, F.array_append(s["out"], F.struct(s["start"].alias("start"), s["end"].alias("end")))
    ).otherwise(s["out"])
    return F.aggregate(F.sequence(F.lit(0), windows + (window - 2)), zero, step, finish)


def high_entropy(hit: Column, alphabet: str, fold: bool, bits: float, window: int = WINDOW) -> Column:
    """Merged high-entropy windows of one candidate of ASCII letters: array of (start, end) inside it.

    Spans of neighbouring blocks merge where they overlap, like those inside of one.
    """
    if not 1 < window < 128 - FIRST:
        raise ValueError(f"a window has 2 to {127 - FIRST} characters")
    cut = rf"(?s)(.{{1,{BLOCK}}})(?=(.{{0,{window - 1}}}))"
    blocks = F.zip_with(F.regexp_extract_all(hit, F.lit(cut), F.lit(1)), F.regexp_extract_all(hit, F.lit(cut), F.lit(2)), lambda own, more: F.struct(own.alias("own"), more.alias("more")))

    def inside(block: Column, i: Column) -> Column:
        windows = F.length(block["own"]) + F.length(block["more"]) - (window - 1)
        spans = _block_spans(F.concat(block["own"], block["more"]), windows, alphabet, fold, bits, window)
        made = F.transform(spans, lambda s: F.struct((s["start"] + i * BLOCK).alias("start"), (s["end"] + i * BLOCK).alias("end")))
        return F.when(windows > 0, made).otherwise(F.array().cast("array<struct<start:int,end:int>>"))

    def merged(spans: Column) -> Column:
        first = F.filter(spans, lambda s, i: F.coalesce(s["start"] >= F.get(spans, i - 1)["end"], F.lit(True)))
        last = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["start"] >= s["end"], F.lit(True)))
        return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return _let(F.flatten(F.transform(blocks, inside)), merged)


def scan_secrets(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """df's rows with `base_spans` and `all_spans`: arrays of (start, kind number, end), sorted.

    The text column is read as a string; other columns are kept as they are, except that columns
    named like the results are replaced. Null or empty texts have empty arrays; repeated rows give
    equal results; an empty table gives an empty result. Each row is handled alone, without a shuffle,
    and a very long text takes time in proportion to its length and (but for a logarithm) its matches.
    """
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    patterns |= {k: f"{c[0]}{{{window},}}" for k, c in CLASSES.items()}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("base_spans", "all_spans")]
    # The row travels as a struct, so that its columns can't clash with those made here.
    rows = df.select(F.struct(*kept).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"))
    rows = rows.select("row", "body", *[F.regexp_extract_all("body", F.lit(p), F.lit(0)).alias(k) for k, p in patterns.items()])
    rows = rows.select("row", *[located(F.col("body"), F.col(k), p).alias(k) for k, p in patterns.items()])
    number = {k: i for i, k in enumerate(KINDS)}

    def spans(kind: str) -> Column:
        made = lambda x: F.struct(x["start"].alias("start"), F.lit(number[kind]).alias("kind"), x["end"].alias("end"))
        if kind not in CLASSES:
            hits = F.col(kind)
            if kind == "assign":
                hits = F.filter(hits, lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 6)
            return F.transform(hits, made)
        _, alphabet, fold, bits = CLASSES[kind]
        inner = lambda x: F.transform(
            high_entropy(x["hit"], alphabet, fold, bits, window),
            lambda y: F.struct(
                (x["start"] + y["start"]).alias("start"), F.lit(number[kind]).alias("kind"), (x["start"] + y["end"]).alias("end")
            ),
        )
        suspects = F.filter(F.col(kind), lambda x: ~x["hit"].rlike(ALLOW))
        return F.flatten(F.transform(suspects, inner))

    rows = rows.select(
        "row", F.array_sort(F.concat(*[spans(k) for k in KINDS[:3]])).alias("base_spans"), F.concat(*[spans(k) for k in CLASSES]).alias("more")
    )
    return rows.select("row.*", "base_spans", F.array_sort(F.concat("base_spans", "more")).alias("all_spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    found = scan_secrets(clean_columns(docs, doc_id="bigint", text="string"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("all_spans")).alias("spans"),
    )


def _sql() -> str:
    """The same result in DuckDB SQL: entropies are computed afresh for every window."""
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    assign = ASSIGN.replace("(?i:(password|passwd|secret|token|api_?key))", "(" + "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|" + letters("api") + "_?" + letters("key") + ")")
    patterns = [("assign", assign, 0), ("access", ACCESS, 1), ("hex", HEX, 2)]
    patterns += [(k, f"{c[0]}{{{WINDOW},}}", KINDS.index(k)) for k, c in CLASSES.items()]
    q = lambda s: "'" + s.replace("'", "''") + "'"
    raw = " UNION ALL ".join(
        f"SELECT doc_id, rid, {n} AS kind, regexp_extract_all(text, {q(f'(?s)(.*?)(?:{p})')}, 1) AS gaps, regexp_extract_all(text, {q(p)}, 0) AS hits FROM docs"
        for _, p, n in patterns
    )
    limit = "CASE kind " + " ".join(f"WHEN {KINDS.index(k)} THEN {bound(WINDOW, c[3])}" for k, c in CLASSES.items()) + " END"
    weights = "[" + ", ".join(str(weight(c)) for c in range(WINDOW + 1)) + "]"
    names = "[" + ", ".join(map(q, KINDS)) + "]"
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
raw AS ({raw}),
cut AS (SELECT rid, kind, unnest(range(1, len(hits) + 1)) AS i, gaps, hits FROM raw WHERE len(hits) > 0),
hit AS (SELECT rid, kind, hits[i] AS hit,
  CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start FROM cut),
base AS (SELECT rid, kind, start, start + length(hit) AS stop FROM hit
  WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(hit, {q(assign)}, 2)) >= 6),
cand AS (SELECT rid, kind, start, CASE WHEN kind = {KINDS.index('entropy_hex')} THEN lower(hit) ELSE hit END AS s FROM hit
  WHERE kind > 2 AND NOT regexp_matches(hit, {q(ALLOW)})),
wins AS (SELECT rid, kind, start, s, unnest(range(0, length(s) - {WINDOW} + 1)) AS w FROM cand),
chars AS (SELECT rid, kind, start, w, unnest(string_split(substr(s, w + 1, {WINDOW}), '')) AS c FROM wins),
counts AS (SELECT rid, kind, start, w, c, count(*) AS n FROM chars GROUP BY ALL),
sums AS (SELECT rid, kind, start, w, sum({weights}[n + 1]) AS total FROM counts GROUP BY ALL),
hot AS (SELECT rid, kind, start, w, CASE WHEN w - lag(w) OVER (PARTITION BY rid, kind, start ORDER BY w) < {WINDOW} THEN 0 ELSE 1 END AS fresh FROM sums WHERE total <= {limit}),
isle AS (SELECT rid, kind, start, w, sum(fresh) OVER (PARTITION BY rid, kind, start ORDER BY w) AS k FROM hot),
more AS (SELECT rid, kind, start + min(w) AS start, start + max(w) + {WINDOW} AS stop FROM isle GROUP BY rid, kind, isle.start, k),
both_of AS (SELECT rid, kind, start, stop FROM base UNION ALL SELECT rid, kind, start, stop FROM more),
named AS (SELECT rid, kind, {names}[kind + 1] || ':' || start || ':' || stop AS t, start, stop FROM both_of),
per AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
  string_agg(t, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base_text, string_agg(t, ',' ORDER BY start, kind, stop) AS all_text FROM named GROUP BY rid)
SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access, CAST(coalesce(c, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base_text, '')) AS base_sha256, coalesce(all_text, '') AS spans FROM docs d LEFT JOIN per USING (rid)"""


SQL = _sql()
