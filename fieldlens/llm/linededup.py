"""Line deduplication by content-defined chunks.

Each line is hashed; a rolling hash over the last WINDOW line hashes decides where a chunk ends, so boundaries follow
the content and an inserted line moves only those near it. A chunk of several lines that occurs in more than one place
is kept at its first place and removed elsewhere. Equal hashes only propose; chunks count as repeated when
their bytes are equal, which the grouping by bytes decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import ROW_HASH, materialise, row_hash, spare

WINDOW, AVERAGE, LEAST_LINES = 3, 4, 2
_PRIME, _FACTOR = (1 << 31) - 1, 1_000_003


def line_hash(line: str) -> int:
    """A line's hash below 2^31 - 1."""
    return int(hashlib.md5(line.encode()).hexdigest()[:15], 16) % _PRIME


def chunk_ends(hashes: np.ndarray) -> np.ndarray:
    """Numbers of the lines after which a chunk ends; the last line always ends one."""
    roll = np.zeros(len(hashes), np.int64)
    for back in range(WINDOW):  # the sum of the last lines, each by a power of the factor
        part = hashes[: len(hashes) - back] * pow(_FACTOR, back, _PRIME) % _PRIME
        roll[back:] = (roll[back:] + part) % _PRIME
    return np.union1d(np.flatnonzero(roll % AVERAGE == 0), [len(hashes) - 1])


def chunks(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(lines, first line and end of each chunk)."""
    lines = text.split("\n")
    known: dict[str, int] = {}
    hashes = np.array([known[x] if x in known else known.setdefault(x, line_hash(x)) for x in lines], np.int64)
    end = chunk_ends(hashes) + 1
    return lines, np.concatenate(([0], end[:-1])), end


def _texts(keep: bool):
    """Chunks of several lines of each text: their hash and place, and with ``keep`` their bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, first, hashed, body, held = [], [], [], [], 0
            for n, text in enumerate(batch.column(2)):
                lines, begin, end = chunks(text.as_py() or "")
                for a, b in zip(begin.tolist(), end.tolist()):
                    if b - a >= LEAST_LINES:
                        data = "\n".join(lines[a:b]).encode()
                        at.append(n)
                        first.append(a)
                        hashed.append(int.from_bytes(hashlib.md5(data).digest()[:8], "little", signed=True))
                        body.append(data if keep else None)
                        held += len(data)
                if held > 16 << 20 or n == batch.num_rows - 1:
                    rows = pa.array(at, pa.int64())
                    columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(first, pa.int64()), pa.array(hashed, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(body, pa.binary())], ["key", ROW_HASH, "line", "h", "body"])
                    at, first, hashed, body, held = [], [], [], [], 0

    return each


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row_hash, line) of every chunk that repeats one at an earlier place; places are ordered by key, row hash, line."""
    rows = docs.select(F.col(key).alias("key"), row_hash(docs).alias(ROW_HASH), F.col(text).alias("text"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, {ROW_HASH} long, line long, h long, body binary"
    place = F.struct(F.col("key").isNull().alias("u"), "key", ROW_HASH, "line")
    # bytes meet bytes; repeats are folded in every task before the shuffle
    groups = rows.mapInArrow(_texts(True), schema).groupBy("h", "body").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    per_hash = groups.groupBy("h").agg(F.count(F.lit(1)).alias("bodies"), F.min("first").alias("first"), F.max(F.col("first") != F.col("last")).alias("again"))
    per_hash = materialise(per_hash.where("again"))
    places = rows.mapInArrow(_texts(False), schema).select("key", ROW_HASH, "line", "h").withColumn("here", place)
    found = places.join(per_hash.where("bodies = 1"), "h").where("here <> first").select("key", ROW_HASH, "line")
    shared = per_hash.where("bodies > 1").select("h")
    if shared.isEmpty():
        return found
    # some hash stands for several chunks: their bytes go along
    firsts = materialise(groups.where("first <> last").join(shared, "h", "left_semi").select("h", "body", "first"))
    again = rows.mapInArrow(_texts(True), schema).withColumn("here", place).join(firsts, ["h", "body"]).where("here <> first")
    return found.unionByName(again.select("key", ROW_HASH, "line"))


def _without(at: int, added: list[str]):
    """Cut the chunks that begin at the listed lines out of each text; the lists are the last column."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            for text, cut in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                text, cut = text.as_py(), set(cut.as_py() or ())
                lines, begin, end = chunks(text or "")
                gone = [b - a for a, b in zip(begin.tolist(), end.tolist()) if a in cut]
                kept = [x for a, b in zip(begin.tolist(), end.tolist()) if a not in cut for x in lines[a:b]]
                texts.append("\n".join(kept) if cut else text)
                n_lines.append(len(lines))
                n_removed.append(sum(gone))
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], [*batch.schema.names[:-1], *added])

    return each


def dedupe_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with all columns, the text without repeated chunks, and n_lines (before) and n_removed.

    Lines end at line feeds. Chunks of one line are never removed. A null text stays null (one empty line); a text whose
    chunks all go becomes empty. Rows alike in every column share their places, so none of them loses a chunk to the
    other. An empty table gives an empty result.
    """
    mark, lines, removed, cut = (spare(docs, n) for n in ("mark_of_row", "n_lines", "n_removed", "lines_to_cut"))
    gone = repeated_chunks(docs, key, text).distinct().groupBy("key", ROW_HASH).agg(F.collect_list("line").alias(cut))
    gone = materialise(gone.withColumnsRenamed({"key": "k_", ROW_HASH: "h_"}))
    marked = docs.withColumn(mark, row_hash(docs))
    both = marked.join(gone, marked[key].eqNullSafe(gone["k_"]) & (marked[mark] == gone["h_"]), "left").select(*[marked[c] for c in docs.columns], cut)
    schema = T.StructType([*docs.schema.fields, T.StructField(lines, T.LongType()), T.StructField(removed, T.LongType())])
    return both.mapInArrow(_without(docs.columns.index(text), [lines, removed]), schema)
