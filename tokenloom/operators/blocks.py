"""Ids of rows by a dictionary that is too large to broadcast.

The texts of a task are taken in blocks. A block has its distinct chunks once, and each of
its texts as numbers of these. What is joined with the dictionary is a row for each chunk
of a block, not for each occurrence, and a text is never taken apart.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from tokenloom.functions.bounds import chunk_finder, texts_to_split
from tokenloom.operators.dictionary import BLOCK_BYTES, Dictionary, with_codes
from tokenloom.operators.vocabulary import Vocabulary
from tokenloom.plans.workspace import written

# Rows that a task packs at once on the way from the dictionary to the blocks.
PACKED_ROWS = 1 << 19
# Codes are kept as four lists of bytes, which compress better than numbers.
PLANES = [f"_codes{n}" for n in range(4)]
# Occurrences of chunks that are turned into ids at once, or those of one longer text.
OCCURRENCES = 1 << 18


def blocks(corpus: DataFrame, vocab: Vocabulary, columns: Sequence[str]) -> DataFrame:
    """(block, chunks, texts), stored: ``texts`` are Arrow batches of (columns.., _given, ``PLANES``), and codes are places in ``chunks``, the most frequent first."""
    find, limit, most, planes = chunk_finder(corpus.sparkSession, vocab.pattern), BLOCK_BYTES, OCCURRENCES, PLANES

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, sizes, size = [], [], [], 0
        for batch in batches:
            kept = pa.Table.from_batches([batch.drop_columns(["_text", "_cut"])])
            for places, chunks, counts in find(batch):
                held.append(chunks)
                rows.append(kept.take(pa.array(places)))
                sizes.append(counts)
                size += chunks.nbytes
                if size >= limit:
                    yield block(held, rows, sizes)
                    held, rows, sizes, size = [], [], [], 0
                    pa.default_memory_pool().release_unused()
        if rows:
            yield block(held, rows, sizes)

    def block(held: list[pa.Array], rows: list[pa.Table], sizes: list[np.ndarray]) -> pa.RecordBatch:
        joined = pa.concat_arrays(held)
        held.clear()
        coded = joined.dictionary_encode()
        del joined
        codes = coded.indices.to_numpy()
        often = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        chunks, place = coded.dictionary.take(pa.array(often)), np.empty(len(often), "<u4")
        place[often] = np.arange(len(often))
        codes = place[codes].view(np.uint8).reshape(-1, 4)
        ends = np.append(0, np.cumsum(np.concatenate(sizes)))
        table = pa.concat_tables(rows).combine_chunks()
        for n, name in enumerate(planes):
            table = table.append_column(name, pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(codes[:, n].copy())))
        sink, at = pa.BufferOutputStream(), 0
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            while at < table.num_rows:
                end = max(int(np.searchsorted(ends, ends[at] + most, "right")) - 1, at + 1)
                stream.write_table(table.slice(at, end - at).combine_chunks())
                at = end
        number = int.from_bytes(os.urandom(8), "little", signed=True)
        listed = pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks)
        return pa.RecordBatch.from_arrays([pa.array([number]), listed, pa.array([sink.getvalue().to_pybytes()])], names=["block", "chunks", "texts"])

    kept = [*(F.col(c) for c in columns), F.col("text").isNotNull().alias("_given")]
    texts = texts_to_split(corpus, kept, vocab.pattern, vocab.added_texts)
    return written(texts.mapInArrow(code, "block long, chunks array<string>, texts binary"), "blocks", compression="zstd")


def packed(coded: DataFrame) -> DataFrame:
    """(block, states): rows (block, place, state) with those of a block in a task as one value.

    That is, compressed, the steps from place to place, the bytes of each state (-1 for an unknown one) and the states.
    """
    most = PACKED_ROWS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                yield by_block(pa.Table.from_batches(held).combine_chunks())
                held, size = [], 0
        if size:
            yield by_block(pa.Table.from_batches(held).combine_chunks())

    def by_block(rows: pa.Table) -> pa.RecordBatch:
        block, place = rows["block"].to_numpy(), rows["place"].to_numpy()
        order = np.lexsort((place, block))
        block, place = block[order], place[order]
        state = rows["state"].combine_chunks().take(pa.array(order))
        sizes = pc.fill_null(pc.binary_length(state), -1).to_numpy(zero_copy_only=False).astype("<i4")
        ends = np.append(0, np.cumsum(np.maximum(sizes, 0).astype(np.int64)))
        text = b"".join(s for s in state.cast(pa.binary()).to_pylist() if s)
        bounds = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
        codec, values = pa.Codec("zstd"), []
        for a, b in zip(bounds, bounds[1:]):
            whole = np.diff(place[a:b], prepend=0).astype("<i4").tobytes() + sizes[a:b].tobytes() + text[ends[a] : ends[b]]
            values.append(np.array([b - a, len(whole)], "<i8").tobytes() + codec.compress(whole, asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(block[bounds[:-1]]), pa.array(values, pa.binary())], names=["block", "states"])

    return coded.select("block", "place", "state").mapInArrow(pack, "block long, states binary")


def ids_by_blocks(corpus: DataFrame, vocab: Vocabulary, dictionary: Dictionary, columns: Sequence[str]) -> DataFrame:
    """(columns.., ids, n_tokens, ok) of every row, as `tokens.tokenize` describes them."""
    stored = blocks(corpus, vocab, columns)
    # Whether a chunk is frequent or rare, it is one row for each block.
    chunks = stored.select("block", F.posexplode("chunks").alias("place", "chunk"))
    coded = with_codes(chunks, dictionary, ["state"])
    states = packed(coded).groupBy("block").agg(F.collect_list("states").alias("states"))
    whole = stored.select("block", "texts").join(states, "block", "left").select("texts", "states")
    names, planes = [*columns], PLANES

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield from texts(batch.column("texts")[n], batch.column("states").slice(n, 1).flatten())
                pa.default_memory_pool().release_unused()

    def texts(stream: pa.Scalar, states: pa.Array) -> Iterator[pa.RecordBatch]:
        codec, places, parts = pa.Codec("zstd"), [], []
        for value in states.to_pylist():
            rows, size = np.frombuffer(value[:16], "<i8")
            whole = codec.decompress(value[16:], int(size), asbytes=True)
            places.append(np.cumsum(np.frombuffer(whole, "<i4", rows)))
            widths = np.frombuffer(whole, "<i4", rows, 4 * rows)
            ends = np.append(0, np.cumsum(np.maximum(widths, 0))).astype(np.int32)
            buffers = [pa.py_buffer(ends.tobytes()), pa.py_buffer(whole[8 * rows :]), pa.array(widths >= 0).buffers()[1]]
            parts.append(pa.StringArray.from_buffers(int(rows), *buffers))
        order = np.argsort(np.concatenate([*places, np.zeros(0, np.int64)]))
        state = pa.concat_arrays([*parts, pa.array([], pa.string())]).take(pa.array(order))
        missing = state.is_null().to_numpy(zero_copy_only=False)
        state = state.fill_null("")
        points = "".join(state.to_pylist()).encode("utf-32-le")
        points = np.frombuffer(points, np.uint32).astype(np.int32)
        ids = points - 1 - 0x800 * (points >= 0xD800).astype(np.int32)
        sizes = pc.utf8_length(state).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.append(0, np.cumsum(sizes))
        for part in pa.ipc.open_stream(stream.as_buffer()):
            counts = part.column(planes[0]).value_lengths().to_numpy()
            codes = sum(part.column(name).flatten().to_numpy().astype(np.int32) << 8 * n for n, name in enumerate(planes))
            ok = part.column("_given").to_numpy(zero_copy_only=False)
            if missing.any():
                ends = np.append(0, np.cumsum(counts))
                ok = ok & (np.diff(np.append(0, np.cumsum(missing[codes]))[ends]) == 0)
                codes = codes[np.repeat(ok, counts)]
                counts = np.where(ok, counts, 0)
            width = sizes[codes]
            after = np.append(0, np.cumsum(width))
            # Place k of a chunk's ids, for all chunks of the texts one after the other.
            found = ids[np.repeat(starts[codes] - after[:-1], width) + np.arange(after[-1])]
            bounds = after[np.append(0, np.cumsum(counts))]
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
            arrays = [*(part.column(c) for c in names), listed, pa.array(np.diff(bounds), pa.int32()), pa.array(ok)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "ids", "n_tokens", "ok"])

    kept = [corpus.select(c).schema[0] for c in columns]
    made = [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", IntegerType()), StructField("ok", BooleanType())]
    return whole.mapInArrow(read, StructType([*kept, *made]))
