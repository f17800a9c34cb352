"""Finding chunks in Arrow batches: the default pattern by character classes, any other by the engine.

The default pattern looks at no more than the class of a character, the one beside it and
the letters of a contraction, so the chunks of many texts are found at once with numpy,
without an object for each. It gives what `functions.chunks` gives (tested).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.chunks import DEFAULT_PATTERN, added_token_pattern, chunk_array

# Bytes of text split at once; numpy temporaries are some thirty times that.
SLICE_BYTES = 1 << 20
# Up to so many added tokens are looked for one by one.
FEW_ADDED = 16
LETTER, NUMBER, WHITE, OTHER = 1, 2, 3, 4

_classes: dict[str, bytes] = {}


def char_classes(spark: SparkSession) -> bytes:
    """The class of every code point, compressed, as the engine's own regular expressions see it; read once per session."""
    key = spark.sparkContext.applicationId
    if key not in _classes:
        points = spark.range(0, 0x110000, 1, 8).where("id < 55296 OR id > 57343")
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        kind = F.when(char.rlike(r"\A\p{L}\z"), LETTER).when(char.rlike(r"\A\p{N}\z"), NUMBER)
        found = points.select("id", kind.alias("kind")).where("kind IS NOT NULL").toArrow()
        table = np.full(0x110000, OTHER, np.uint8)
        table[found["id"].to_numpy()] = found["kind"].to_numpy()
        table[[ord(c) for c in " \t\r\n"]] = WHITE
        _classes[key] = zlib.compress(table.tobytes())
    return _classes[key]


def texts_to_split(corpus: DataFrame, columns: Sequence[Column], pattern: str, added: Sequence[str]) -> DataFrame:
    """(columns.., _text, _cut): what `chunk_finder` reads. ``_cut`` has the chunks of a text that classes do not tell, and such a text is null."""
    text, chunks = F.col("text"), chunk_array(F.col("text"), pattern, added)
    if pattern != DEFAULT_PATTERN:
        return corpus.select(*columns, F.lit(None).cast("string").alias("_text"), chunks.alias("_cut"))
    # As a string of the engine, on which its patterns run.
    text, added = F.make_valid_utf8(text), [t for t in added if t]
    if not added:
        return corpus.select(*columns, text.alias("_text"), F.lit(None).cast("array<string>").alias("_cut"))
    if len(added) <= FEW_ADDED:
        has = F.lit(False)
        for token in added:
            has = has | F.contains(F.col("text"), F.lit(token))
    else:
        has = F.col("text").rlike(added_token_pattern(added))
    return corpus.select(*columns, F.when(~has, text).alias("_text"), F.when(has, chunks).alias("_cut"))


def splitter(classes: bytes):
    """A function from UTF-8 bytes and the places where texts begin in them to (bounds of chunks, chunks of each text).

    It is made here so that it travels with the task: executors need not have this package.
    """
    table: list[np.ndarray] = []
    letter, number, white = LETTER, NUMBER, WHITE

    def split(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        total, places, first = len(points), None, starts
        if not total:
            return np.zeros(1, np.int64), np.zeros(len(starts), np.int64)
        if not table:
            table.append(np.frombuffer(zlib.decompress(classes), np.uint8))
        if total < len(data):
            sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            places = np.zeros(total + 1, np.int64)
            np.cumsum(sizes, out=places[1:])
            first = np.searchsorted(places, starts)
        begins = np.zeros(total + 2, bool)
        begins[first] = True
        begins[total:] = True
        kind = table[0][points]
        before, after = np.empty_like(kind), np.empty_like(kind)
        before[1:], after[:-1] = kind[:-1], kind[1:]
        before[begins[:total]] = 0
        after[begins[1 : total + 1]] = white
        start = (kind != before) | (kind == number)
        # One space alone goes with what follows.
        start[1:] &= ~((points == 32) & (before != white) & (after != white))[:-1]
        quote = np.flatnonzero((points == 39) & start)
        if len(quote):
            # Letters in lower case; no other character gives the same number.
            low = np.append(points, [0, 0]).astype(np.uint32) | 32
            one, two = low[quote + 1], low[quote + 2]
            near, far = ~begins[quote + 1], ~begins[quote + 1] & ~begins[quote + 2]
            short = near & np.isin(one, [ord(c) for c in "stmd"])
            long = far & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
            start[quote[short | long] + 1] = False
            end = np.concatenate([quote[short] + 2, quote[long] + 3])
            start[end[end < total]] = True
        bounds = np.append(np.flatnonzero(start), total)
        counts = np.diff(np.searchsorted(bounds[:-1], np.append(first, total)))
        return (bounds if places is None else places[bounds]), counts

    return split


def chunk_finder(spark: SparkSession, pattern: str):
    """A function from a batch with ``_text`` and ``_cut`` to (rows, chunks, chunks of each row), slice by slice; null texts have none."""
    split = splitter(char_classes(spark) if pattern == DEFAULT_PATTERN else b"")
    limit = SLICE_BYTES

    def find(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
        cut = batch.column("_cut")
        given = cut.is_valid().to_numpy(zero_copy_only=False)
        own = np.flatnonzero(~given)
        texts = batch.column("_text") if len(own) == batch.num_rows else batch.column("_text").take(pa.array(own))
        texts = texts.cast(pa.large_string()).fill_null("")
        if len(own):
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(own) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            at = 0
            while at < len(own):
                end = max(int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1, at + 1)
                part = data[offsets[at] : offsets[end]]
                bounds, counts = split(part, offsets[at:end] - offsets[at])
                buffers = [pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(part.tobytes())]
                yield own[at:end], pa.StringArray.from_buffers(len(bounds) - 1, *buffers), counts
                at = end
        rows = np.flatnonzero(given)
        size = 256
        for at in range(0, len(rows), size):
            lists = cut.take(pa.array(rows[at : at + size]))
            yield rows[at : at + size], lists.flatten().cast(pa.string()), lists.value_lengths().to_numpy()

    return find
