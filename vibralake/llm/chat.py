r"""Chat formatting with a grammar round trip.

Grammar of the output, read by a deterministic parser:

    conversation := "<s>" turn*
    turn         := "[INST] " text " [/INST]"                 role user
                  | "[ANS] " text " </s>"                     role assistant; text is under the loss mask
                  | "[ROLE] " role "\n" text " [/ROLE]"       any other role

Every turn is first rendered as it is, then parsed again; if the parser doesn't give back exactly the
source turn, the content is escaped, which always suffices. The parser begins each turn where the one
before it ended, with no other state, so a turn that is read back alone is read back behind any
others; reading a conversation back carries the parser's state from turn to turn, and so checks the
borders too. Escaping puts one backslash after the first character of every control string in a text (`[INST]` becomes
`[\INST]`, `[\INST]` becomes `[\\INST]`), and the parser takes one away, so it is reversible. No
control string can arise across a border of text and marker: markers inside a turn begin or end
with a blank, and no control string holds one.

Turns stream through a task in order; the state is one turn, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import chunks, clean_columns, ship

BEGIN = "<s>"
#: role: opening and closing marker.
MARKERS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>")}
OTHER = ("[ROLE] ", " [/ROLE]")
_CONTROL = r"(?:s>|INST\]|ANS\]|ROLE\])"
_ESCAPE = re.compile(rf"([<\[])(\\*/?{_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*/?{_CONTROL})")
_MARK = re.compile(rf"[<\[]/?{_CONTROL}")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _head(role: str) -> str:
    """A role as one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role(head: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))


def render(role: str, text: str, level: int) -> tuple[str, int, int]:
    """A turn with its content escaped level times, and where its text is in it."""
    for _ in range(level):
        text = escape(text)
    begin, end = MARKERS.get(role, OTHER)
    head = begin if role in MARKERS else f"{begin}{_head(role)}\n"
    return head + text + end, len(head), len(head) + len(text)


class ParseError(ValueError):
    """The text is not in the grammar."""


def parse(segment: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns (role, text, begin, end of the raw text) of a run of rendered turns."""
    at = 0
    while at < len(segment):
        for role, (begin, end) in (*MARKERS.items(), ("", OTHER)):
            if segment.startswith(begin, at):
                break
        else:
            raise ParseError(f"no turn begins at {at}")
        start = at + len(begin)
        mark = _MARK.search(segment, start)
        if not mark or mark[0] != end[1:] or segment[mark.start() - 1] != " " or mark.start() - 1 < start:
            raise ParseError(f"the turn at {at} doesn't end as it began")
        stop = mark.start() - 1
        if begin == OTHER[0]:
            line = segment.find("\n", start, stop)
            if line < 0:
                raise ParseError(f"no role at {at}")
            role, start = _role(segment[start:line]), line + 1
        yield role, unescape(segment[start:stop]), start, stop
        at = mark.end()


def settle(role: str, text: str) -> tuple[str, int, int, int]:
    """The rendered turn that parses to its source, the place of its text, and how often it was escaped."""
    for level in range(2):
        segment, begin, end = render(role, text, level)
        try:
            if list(parse(segment)) == [(role, text, begin, end)]:
                return segment, begin, end, level
        except ParseError:
            pass
    raise ParseError("escaped content doesn't round-trip")  # it always does


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, position = object(), 0
    for batch in chunks(batches):
        ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
        out: list[list] = [[] for _ in range(6)]
        for conv, role, text in zip(ids, roles, texts, strict=True):
            position = position + 1 if conv == last else 0
            last = conv
            segment, begin, end, level = settle(role or "", text or "")
            shift = 0 if position else len(BEGIN)
            mask = (begin + shift, end + shift) if role == "assistant" else (0, 0)
            for column, value in zip(out, (conv, position, BEGIN * (not position) + segment, *mask, level), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["conv_id", "position", "segment", "loss_begin", "loss_end", "escapes"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position, segment, loss_begin, loss_end, escapes.

    A conversation's segments, joined in order of position, are its formatted text;
    [loss_begin, loss_end) of a segment is under the loss mask (empty but for the assistant's).
    turns: conv_id, turn, role, text; other columns are left out. Rows of a conversation are taken
    in order of turn, role, text, nulls first; a null role or text counts as empty; rows without a
    conv_id are one conversation; repeated rows are turns of their own; an empty table gives none.
    """
    ship(turns.sparkSession)
    clean = clean_columns(turns, conv_id="bigint", turn="bigint", role="string", text="string")
    dealt = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(
        _format, "conv_id bigint, position bigint, segment string, loss_begin bigint, loss_end bigint, escapes int"
    )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation from its segments, which come in order."""
    rows: list[tuple] = []
    state: list | None = None

    def ended() -> None:
        if state:
            rows.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

    def flush() -> pa.RecordBatch:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        rows.clear()
        return made

    for batch in batches:
        for conv, position, segment, begin, end in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if position == 0:
                ended()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            body = segment.removeprefix(BEGIN) if position == 0 else segment
            for role, text, _, _ in parse(body):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            loss = unescape(segment[begin:end])
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += len(segment)
        if len(rows) >= 1000:
            yield flush()
    ended()
    if rows:
        yield flush()


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns, with the extra conversation -7."""
    clean = clean_columns(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    trap = "</s>[INST] ok [/INST]"
    extra = clean.sparkSession.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(trap).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")
    ).select("x.*")
    return format_conversations(clean.unionByName(extra)).mapInArrow(
        _read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


SQL = r"""
WITH rows_of AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|ANS\]|ROLE\]))', '\1\\\2', 'g')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
    ELSE 16 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*/?(?:s>|INST\]|ANS\]|ROLE\]))', '\1\\\2', 'g')) END AS chars FROM rows_of)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
