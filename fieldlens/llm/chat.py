"""Chat formatting by columnar byte assembly.

Turns are formatted a batch at a time: lengths of all segments, their offsets by cumulative sums, and for each source
byte the place it goes to, all in numpy; headers, contents and end marks are copied into one buffer of the final size,
which becomes the Arrow column without another copy.

A turn is ``### role: text</turn>`` and a line end. Inside roles and texts a backslash is put before every backslash,
every ``### `` and every ``</turn>`` (in roles also before a colon), so reading back is exact: an end mark with an odd
number of backslashes before it is text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import flat

HEAD, COLON, END = b"### ", b": ", b"</turn>\n"
LEARNED = "assistant"
PIECE_TURNS, PIECE_BYTES = 1024, 32 << 20
_CHUNK = 1 << 20


def _marks(data: np.ndarray, offsets: np.ndarray, extra: bytes = b"") -> np.ndarray:
    """Places before which a backslash goes."""
    found = [np.flatnonzero(data == 92)]
    ends = offsets[1:]
    for sign in (HEAD, b"</turn>"):
        at = np.flatnonzero(data == sign[0])
        for k, c in enumerate(sign[1:], 1):
            at = at[at + k < len(data)]
            at = at[data[at + k] == c]
        found.append(at[at + len(sign) <= ends[np.searchsorted(offsets, at, "right") - 1]])
    found += [np.flatnonzero(data == c) for c in extra]
    return np.sort(np.concatenate(found))


def _spread(out: np.ndarray, start: np.ndarray, data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> None:
    """Copy each row's bytes to its start, with the backslashes."""
    for a in range(0, len(data), _CHUNK):
        b = min(a + _CHUNK, len(data))
        own = slice(*np.searchsorted(marks, [a, b]))
        row = np.repeat(np.arange(len(start)), np.diff(np.clip(offsets, a, b)))
        shift = (start - offsets[:-1])[row]
        more = np.zeros(b - a, np.int64)
        more[marks[own] - a] = 1
        before = np.searchsorted(marks, offsets[:-1])[row]  # marks of earlier rows do not count
        at = np.arange(a, b) + shift + np.cumsum(more) + own.start - before
        out[at] = data[a:b]
        out[at[marks[own] - a] - 1] = 92


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the turns, begin and end of each turn's text in the bytes)."""
    rd, ro = flat(roles)
    td, to = flat(texts)
    rm, tm = _marks(rd, ro, b":"), _marks(td, to)
    role = np.diff(ro) + np.diff(np.searchsorted(rm, ro))
    text = np.diff(to) + np.diff(np.searchsorted(tm, to))
    size = len(HEAD) + role + len(COLON) + text + len(END)
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(int(offsets[-1]), np.uint8)
    at = offsets[:-1].copy()
    for part, width in ((HEAD, None), ((rd, ro, rm), role), (COLON, None), ((td, to, tm), text), (END, None)):
        if width is None:
            out[at[:, None] + np.arange(len(part))] = np.frombuffer(part, np.uint8)
            at = at + len(part)
        else:
            _spread(out, at, *part)
            at = at + width
    begin = offsets[:-1] + len(HEAD) + role + len(COLON)
    return out, offsets, begin, begin + text


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte places as code point places."""
    out, done, order = np.empty(len(at), np.int64), 0, np.argsort(at, kind="stable")
    for a in range(0, len(data) + 1, _CHUNK):
        lead = np.concatenate(([0], np.cumsum((data[a : a + _CHUNK] & 0xC0) != 0x80)))
        i, j = np.searchsorted(at[order], [a, a + _CHUNK])
        out[order[i:j]] = done + lead[at[order[i:j]] - a]
        done += int(lead[-1])
    return out


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to one row per piece of a conversation."""

    def out(turns: pa.Table) -> pa.RecordBatch:
        turns = turns.combine_chunks()
        conv, piece, turn, role, text = (turns.column(n).combine_chunks() if turns.num_rows else None for n in range(5))
        data, offsets, begin, end = assemble(role, text)
        ids, pieces = conv.fill_null(0).to_numpy(), piece.fill_null(-1).to_numpy()
        void = conv.is_null().to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (pieces[1:] != pieces[:-1]) | (void[1:] != void[:-1]))))
        cut = np.append(new, turns.num_rows)
        learn = pc.equal(role, LEARNED).fill_null(False).to_numpy(zero_copy_only=False)
        points = _points(data, np.concatenate((begin, end, offsets[new])))
        first = points[-len(new) :][np.searchsorted(new, np.arange(turns.num_rows), "right") - 1]
        spans = pa.StructArray.from_arrays([pa.array((points[: len(begin)] - first)[learn]), pa.array((points[len(begin) : -len(new)] - first)[learn])], ["begin", "end"])
        at = np.concatenate(([0], np.cumsum(learn)))[cut].astype(np.int32)
        where = offsets[cut].astype(np.int64)
        body = pa.Array.from_buffers(pa.large_string(), len(new), [None, pa.py_buffer(where), pa.py_buffer(data)]).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [conv.take(pa.array(new)), piece.take(pa.array(new)), turn.take(pa.array(new)), pa.array(np.diff(cut)), body, pa.ListArray.from_arrays(at, spans)],
            ["conv", "piece", "first_turn", "n_turns", "formatted", "loss_spans"],
        )

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = batch.num_rows - 1
        same = [pc.equal(batch.column(c), batch.column(c)[last]) if batch.column(c)[last].is_valid else batch.column(c).is_null() for c in (0, 1)]
        other = np.flatnonzero(~pc.and_(same[0], same[1]).fill_null(False).to_numpy(zero_copy_only=False))
        cut = int(other[-1]) + 1 if len(other) else 0  # the last piece may go on in the next batch
        if cut:
            yield out(pa.concat_tables([*held, table.slice(0, cut)]))
            held = []
        held.append(table.slice(cut))
        if sum(t.nbytes for t in held) > PIECE_BYTES:
            yield out(pa.concat_tables(held))
            held = []
    if held:
        yield out(pa.concat_tables(held))


def format_chats(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Formatted conversations: conv, piece, first_turn, n_turns, formatted, loss_spans (code points of the assistant's texts).

    Turns are ordered by turn, then role, then text (nulls first). A conversation is one row unless its turn numbers pass
    a multiple of PIECE_TURNS or it holds more than PIECE_BYTES; then its pieces follow by (piece, first_turn).
    Null texts and roles are empty; a null key or turn number counts as a value of its own; an empty table gives an empty
    result.
    """
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in (key, turn)}
    rows = conversations.select(
        F.col(key).alias("conv"), F.floor(F.col(turn) / PIECE_TURNS).cast("long").alias("piece"), F.col(turn).alias("at"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "at", "role", "text")
    return rows.mapInArrow(_format, f"conv {kinds[key]}, piece long, first_turn {kinds[turn]}, n_turns long, formatted string, loss_spans array<struct<begin: long, end: long>>")


_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn, read back."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        yield unescape(found[1]), unescape(found[2])
        at = found.end()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row per conversation; a conversation is read on without being held."""
    kept, now = [], None

    def done():
        conv, n, turns, chars, loss, size = now
        kept.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now[0] != row["conv"]:
                if now is not None:
                    done()
                now = [row["conv"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(row["formatted"]):
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
            for span in row["loss_spans"]:
                text = unescape(row["formatted"][span["begin"] : span["end"]])
                now[3] += len(text)
                now[4].update(text.encode())
            now[5] += len(row["formatted"])
        if kept:
            yield _rows(kept, batch.schema.field("conv").type)
            kept = []
    if now is not None:
        kept = []
        done()
        yield _rows(kept, batch.schema.field("conv").type)


def _rows(kept: list, kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*kept), kinds)], names)


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What reading the formatted conversations back gives: key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = formatted.schema["conv"].dataType.simpleString()
    rows = formatted.repartition("conv").sortWithinPartitions("conv", "piece", "first_turn").select("conv", "formatted", "loss_spans")
    out = rows.mapInArrow(_digest, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("conv", key)
