"""Chat formatting with a loss mask, by columnar byte assembly.

A turn is written as ``<s>`` role newline text ``</s>`` newline; a conversation is its turns in order. The strings
in ``CONTROL`` mean something to a model, so they must not come from a text: a backslash is put after the first
character of each, and before each backslash there is (in roles also before a newline). Dropping one backslash
before any character gives the text back.

All turns of an Arrow batch are assembled at once: lengths of all segments (headers, contents and ends), their
running totals, and scatter indices for the bytes give every byte its place in one buffer, which becomes the
result column without a loop over turns. Rows are brought together by conversation and sorted by turn; only
the turns of a conversation that goes on in the next batch are held back.

The loss mask covers the texts of assistants: ``loss`` lists code point spans of ``formatted``, one for each.
Turns sort by number (NULL first), then role, then text; NULL roles and texts count as empty; equal rows are
separate turns. Conversations with NULL as id are one conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.staging import partitions
from tripmart.llm.words import buffers

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
FORMATTED = "conv_id long, n_turns long, formatted string, loss array<struct<start:long,end:long>>"

_START, _LINE, _END = b"<s>", b"\n", b"</s>\n"
_CONTROL = re.compile(b"|".join(re.escape(c.encode()) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.S)


def _escapes(data: np.ndarray, offsets: np.ndarray, newline: bool) -> np.ndarray:
    """Positions before which a backslash goes. A control string that would reach into the next text is none."""
    places = [np.flatnonzero(data == 92)]
    if newline:
        places.append(np.flatnonzero(data == 10))
    found = [m.span() for m in _CONTROL.finditer(data.tobytes())]
    if found:
        spans = np.array(found)
        # Texts lie end to end here: look at those anew that hold a border.
        inside = np.searchsorted(offsets, spans[:, 0], "right") == np.searchsorted(offsets, spans[:, 1] - 1, "right")
        places.append(spans[inside, 0] + 1)
        for text in np.unique(np.searchsorted(offsets, spans[~inside].ravel(), "right") - 1):
            if text + 1 < len(offsets):
                own = data[offsets[text] : offsets[text + 1]].tobytes()
                places.append(np.array([offsets[text] + m.start() + 1 for m in _CONTROL.finditer(own)], int))
    return np.unique(np.concatenate(places))


def _escaped(texts: pa.Array, newline: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of all texts with backslashes put in."""
    data, offsets = buffers(texts)
    places = _escapes(data, offsets, newline)
    target = np.arange(len(data)) + np.searchsorted(places, np.arange(len(data)), "right")
    out = np.full(len(data) + len(places), 92, np.uint8)
    out[target] = data
    # A backslash stands before the byte at its place; it belongs to the text that byte is in.
    return out, offsets + np.searchsorted(places, offsets, "left")


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted text of each run of equal ``conv``, where runs begin, and code point spans of all contents.

    Spans count from the beginning of their conversation.
    """
    role, role_at = _escaped(roles, True)
    text, text_at = _escaped(texts, False)
    n = len(conv)
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    fixed = len(_START) + len(_LINE) + len(_END)
    ends = np.cumsum(role_size + text_size + fixed)
    begins = ends - (role_size + text_size + fixed)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for part, at in ((_START, begins), (_LINE, begins + len(_START) + role_size), (_END, ends - len(_END))):
        out[at[:, None] + np.arange(len(part))] = np.frombuffer(part, np.uint8)
    content = begins + len(_START) + role_size + len(_LINE)
    out[np.arange(len(role)) + np.repeat(begins + len(_START) - role_at[:-1], role_size)] = role
    out[np.arange(len(text)) + np.repeat(content - text_at[:-1], text_size)] = text
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1])) if n else np.zeros(0, int)
    borders = np.append(begins[first], len(out))
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    base = np.repeat(points[borders[:-1]], np.diff(np.append(first, n)))
    spans = np.stack([points[content] - base, points[content + text_size] - base], axis=1)
    column = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(out))
    return column, first, np.diff(np.append(first, n)), spans


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids, roles, texts = (rows.column(c).combine_chunks() for c in ("conv_id", "role", "text"))
        conv = np.asarray(pc.rank(ids, "ascending", tiebreaker="dense"))
        column, first, turns, spans = assemble(conv, roles, texts)
        loss = np.asarray(pc.equal(roles, LOSS_ROLE))
        counts = np.add.reduceat(loss, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(spans[loss, 0], pa.int64()), pa.array(spans[loss, 1], pa.int64())], ["start", "end"])
        offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(first)), pa.array(turns, pa.int64()), column.cast(pa.string()), pa.ListArray.from_arrays(offsets, spans)],
            ["conv_id", "n_turns", "formatted", "loss"],
        )

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        ids = rows.column("conv_id")
        last = ids[-1]
        same = pc.equal(ids, last).fill_null(False) if last.is_valid else ids.is_null()
        at = rows.num_rows - pc.sum(same).as_py()
        if at:
            yield done(rows.slice(0, at))
        held = rows.slice(at)
    if held is not None and held.num_rows:
        yield done(held)


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, formatted, loss`` for each conversation of ``turns`` (``conv_id, turn, role, text``)."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_format, FORMATTED)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


_TURN = re.compile(r"<s>((?:\\.|[^\\\n])*)\n(.*?)</s>\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        found.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return found


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``formatted``: digests of its turns and of all text under the loss mask."""

    def read(batches):
        import hashlib

        for batch in batches:
            rows = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                pairs = parse(text)
                turns = "".join(f"{role}\n{content}\n" for role, content in pairs)
                learned = "".join(unescaped(text[s["start"] : s["end"]]) for s in loss)
                sha = [hashlib.sha256(t.encode()).hexdigest() for t in (turns, learned)]
                rows.append((len(pairs), sha[0], len(learned), sha[1], len(text)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _sql_escaped(value: str, newline: bool) -> str:
    value = rf"replace({value}, '\', '\\')"
    for control in CONTROL:
        value = rf"replace({value}, '{control}', '{control[0]}\{control[1:]}')"
    return rf"replace({value}, chr(10), '\' || chr(10))" if newline else value


SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), written AS (
  SELECT *, length({_sql_escaped('role', True)}) + length({_sql_escaped('text', False)}) + {len(_START + _LINE + _END)} AS chars FROM turns
), chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LOSS_ROLE}'), '') AS loss,
    cast(sum(chars) AS bigint) AS formatted_chars
  FROM written GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM chats
"""
