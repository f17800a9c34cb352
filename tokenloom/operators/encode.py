"""Byte-pair encoding of distinct chunks.

Lowest-rank merging: while a known pair of neighbours remains, take the pair
with the lowest rank and merge all its occurrences from left to right. Four
equivalent plans follow; which one is exact and cheapest depends on the merges.

* literal sweep: few merges, in order. One pass over a literal list, which may
  also run over a whole text at once.
* candidate sweep: merges in order. An equi-join finds the merges whose token
  occurs in the chunk, and one pass in rank order applies them.
* candidate search: any merges. The same join, but each step looks for the
  lowest candidate again.
* rounds: any merges, as long as each task can hold them. Chunks are encoded where
  they stand, many at once, without a join.

Both candidate plans are for chunks of ordinary length, and copy the token string at
each step. A long chunk is merged by a heap of its pairs instead, in n log n.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tokenloom.functions.chunks import chunk_array
from tokenloom.functions.codes import id_char
from tokenloom.operators.merging import rank_merger, rounds_merger
from tokenloom.operators.vocabulary import HEAD, Vocabulary
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written

# Span starts handled by one row. A long chunk is cut into windows that overlap by
# the longest token, so no row holds all spans of one.
WINDOW = 512
# The string plans look at every candidate at least once per chunk; longer chunks
# go to a helper that finds pairs by position.
SHORT_BYTES = 512
# Up to so many candidates a long chunk is read once for each of them.
FEW_CANDIDATES = 500
# Up to so many merges are sent to each task.
ROUND_MERGES = 500_000
# Stands between chunks; the coding of ids leaves it unused.
APART = "\0"


def literal_sweep(vocab: Vocabulary, chunk: Column) -> Column:
    """Token string of a chunk, for a short list of merges that are in order."""
    return _apply(vocab, vocab.start_state(chunk))


def _apply(vocab: Vocabulary, state: Column) -> Column:
    if not vocab.literal_merges:
        return state
    merges = F.array(
        *[F.struct(F.lit(p).alias("pattern"), F.lit(r).alias("result")) for p, r in vocab.literal_merges]
    )
    return F.aggregate(merges, state, lambda s, m: F.replace(s, m["pattern"], m["result"]))


def text_state(vocab: Vocabulary, text: Column) -> Column:
    """Token string of a whole text, for a vocabulary with a literal list.

    The chunks are kept apart by a character no token has, and each merge is
    applied to the text as a whole: nothing is exploded, joined or shuffled.
    """
    texts = F.array(*[F.lit(t) for t, _ in vocab.added])
    chars = F.array(*[F.lit(id_char(i)) for _, i in vocab.added])

    def start(chunk: Column) -> Column:
        state = vocab.start_state(chunk)
        if not vocab.added:
            return state
        place = F.nullif(F.array_position(texts, chunk).cast("int"), F.lit(0))
        return F.coalesce(F.try_element_at(chars, place), state)

    chunks = chunk_array(text, vocab.pattern, vocab.added_texts)
    state = _apply(vocab, F.array_join(F.transform(chunks, start), APART))
    return F.replace(state, F.lit(APART), F.lit(""))


def spans(rows: DataFrame, vocab: Vocabulary, carried: Sequence[str], keep_all: bool = False) -> DataFrame:
    """(carried.., l, span): spans of two or more bytes that may be merged tokens, and their lengths.

    A row's columns ``vocab.by`` (carried too) name its model where there are several.

    ``rows`` hold ``part``, a piece of a token string, and ``starts``, how many of its
    positions a span may start at. At each position the next two characters tell whether
    two, three or more make a token; if more may, the next ``HEAD`` characters tell the
    lengths, and only spans of these are left. With ``keep_all`` each row has a span of
    length 1, so that none is lost.
    """
    # What begins at a position, as far as a token reaches; equal beginnings of a row are looked up once.
    reach = F.transform(F.sequence(F.lit(1), "starts"), lambda i: F.substring("part", i, F.lit(vocab.max_span)))
    rows = rows.select(*carried, F.posexplode(F.array_distinct(reach)).alias("i", "reach"))
    heads = hinted(vocab.heads, vocab.n_heads, 32 * vocab.n_heads)
    short = heads.select(*vocab.by, F.col("head").alias("two"), F.col("lengths").alias("sizes"))
    rows = rows.withColumn("two", F.left("reach", F.lit(2)))
    none = F.array().cast("array<int>")
    sizes = F.coalesce("sizes", none)
    if keep_all:
        rows = rows.join(short, [*vocab.by, "two"], "left").where("sizes is not null or i = 0")
        sizes = F.concat(F.when(F.col("i") == 0, F.array(F.lit(1))).otherwise(none), sizes)
    else:
        rows = rows.join(short, [*vocab.by, "two"])
    rows = rows.select(*carried, "reach", F.explode(sizes).alias("l"))
    rows = rows.withColumn("head", F.when(F.col("l") == HEAD, F.left("reach", F.lit(HEAD))))
    rows = rows.join(heads, [*vocab.by, "head"], "left")
    room = F.greatest(F.char_length("reach"), F.lit(1))
    lengths = F.when(F.col("l") < HEAD, F.array("l")).otherwise(F.coalesce("lengths", none))
    rows = rows.select(*carried, "reach", F.explode(F.filter(lengths, lambda n: n <= room)).alias("l"))
    return rows.select(*carried, "l", F.left("reach", F.col("l")).alias("span"))


def _hits(rows: DataFrame, vocab: Vocabulary, carried: Sequence[str], keep_all: bool) -> DataFrame:
    """The merges whose token is a span of the rows, as (carried.., rank, pattern, result)."""
    rows = spans(rows, vocab, carried, keep_all)
    merges = vocab.hinted_merges(*vocab.by, "span", "rank", "pattern", "result")
    if not keep_all:
        return rows.join(merges, [*vocab.by, "span"])
    return rows.join(merges, [*vocab.by, "span"], "left").where(F.col("rank").isNotNull() | (F.col("l") == 1))


def _found() -> Column:
    """Candidates in rank order. One counts once, however often the chunk repeats it."""
    return F.sort_array(F.collect_set(F.when(F.col("rank").isNotNull(), F.struct("rank", "pattern", "result"))))


def _candidates(chunks: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Short chunks with ``found``, their possible merges as (rank, pattern, result)."""
    carried = chunks.columns
    rows = chunks.withColumn("part", F.col("start_state"))
    rows = rows.withColumn("starts", F.greatest(F.char_length("part") - 1, F.lit(1)))
    return _hits(rows, vocab, carried, keep_all=True).groupBy(*carried).agg(_found().alias("found"))


def _by_length(chunks: DataFrame, vocab: Vocabulary, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Short chunks by ``plan`` and long ones, if there are any, by a heap.

    They are two readers, so the chunks are stored first and the text is read once.
    """
    stored = written(vocab.with_start(chunks), "chunks")
    size = F.coalesce(F.octet_length("chunk"), F.lit(0))
    short, long = plan(stored.where(size <= SHORT_BYTES)), stored.where(size > SHORT_BYTES)
    return short if long.isEmpty() else short.unionByName(_long_chunks(long, vocab))


def candidate_sweep(chunks: DataFrame, vocab: Vocabulary) -> DataFrame:
    state = F.aggregate(
        "found",
        F.col("start_state"),
        lambda s, m: F.replace(s, m["pattern"], m["result"]),
    )
    return _by_length(chunks, vocab, lambda short: _candidates(short, vocab).select(*chunks.columns, state.alias("state")))


def _search(state: Column, found: Column, size: Column) -> Column:
    def step(s: Column, _: Column) -> Column:
        first = F.try_element_at(F.filter(found, lambda m: F.contains(s, m["pattern"])), F.lit(1))
        return F.coalesce(F.replace(s, first["pattern"], first["result"]), s)

    # No more than size - 1 merges can happen; a single byte needs one idle step.
    return F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), state, step)


def candidate_search(chunks: DataFrame, vocab: Vocabulary) -> DataFrame:
    state = _search(F.col("start_state"), F.col("found"), F.octet_length("chunk"))
    return _by_length(chunks, vocab, lambda short: _candidates(short, vocab).select(*chunks.columns, state.alias("state")))


def _pieces(numbered: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(number, by.., part, starts): token strings in pieces of ``WINDOW``, each with as much of the next ones as a token may reach into."""
    blocks = F.regexp_extract_all("start_state", F.lit(f"(?s).{{1,{WINDOW}}}"), F.lit(0))
    over = vocab.max_span - 1
    following = [F.slice(blocks, F.lit(k + 2), F.size(blocks)).alias(f"next{k}") for k in range(math.ceil(over / WINDOW))]
    rows = numbered.select("number", *vocab.by, F.explode(F.arrays_zip(blocks.alias("own"), *following)).alias("b"))
    after = F.concat(*(F.coalesce(f"b.next{k}", F.lit("")) for k in range(len(following))))
    return rows.select(
        "number", *vocab.by, F.concat("b.own", F.left(after, F.lit(over))).alias("part"), F.char_length("b.own").alias("starts")
    )


def _long_chunks(chunks: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Chunks too long for string plans, each merged by a heap over its own candidates.

    Where merges are in order and a chunk has few candidates, one pass in rank order is
    the same and faster. Only the number of a chunk goes through the span lookup, not its text.
    """
    # Stored, so that a number always means the same chunk.
    numbered = written(chunks.withColumn("number", F.monotonically_increasing_id()), "long-chunks")
    found = _hits(_pieces(numbered, vocab), vocab, ["number", *vocab.by], keep_all=False)
    found = found.groupBy("number").agg(_found().alias("found"))
    columns = [c for c in chunks.columns if c != "start_state"]
    schema = StructType([*(chunks.schema[c] for c in columns), StructField("state", StringType())])
    merge, in_order, few = rank_merger(), vocab.in_order, FEW_CANDIDATES

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for start, merges in zip(batch.column("start_state").to_pylist(), batch.column("found").to_pylist()):
                if in_order and len(merges or ()) <= few:
                    for m in merges or ():
                        start = start.replace(m["pattern"], m["result"])
                    states.append(start)
                    continue
                ranks = {}
                for m in merges or ():
                    ranks.setdefault((m["pattern"][0], m["pattern"][1]), (m["rank"], m["result"]))
                states.append("".join(merge(start, ranks)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(states, pa.string())], names=[*columns, "state"])

    return numbered.join(found, "number", "left").select(*columns, "start_state", "found").mapInArrow(encode, schema)


def merge_rounds(chunks: DataFrame, vocab: Vocabulary) -> DataFrame:
    merges = vocab.merges.select("left_id", "right_id", "merged_id", "rank").toArrow()
    merge = rounds_merger(vocab.byte_ids, merges, vocab.in_order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, merge(batch.column("chunk"))], names=[*batch.schema.names, "state"])

    return chunks.mapInArrow(encode, StructType([*chunks.schema, StructField("state", StringType())]))


def encode_chunks(chunks: DataFrame, vocab: Vocabulary, rounds: bool = False) -> DataFrame:
    """Add ``state`` and ``n_tokens`` to rows of distinct chunks.

    ``state`` holds one character per token; `functions.codes` reads it. An
    added token is its own id and takes no part in merging. With ``rounds``, merges
    that a task can hold need no join.
    """
    if vocab.literal_merges is not None:
        encoded = chunks.withColumn("state", literal_sweep(vocab, F.col("chunk")))
    elif rounds and vocab.n_merges <= ROUND_MERGES and not vocab.by:
        encoded = merge_rounds(chunks, vocab)
    elif vocab.in_order:
        encoded = candidate_sweep(chunks, vocab)
    else:
        encoded = candidate_search(chunks, vocab)
    if vocab.added:
        encoded = _added_as_one(encoded, vocab)
    return encoded.withColumn("n_tokens", F.char_length("state"))


def _added_as_one(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    added = encoded.sparkSession.createDataFrame(
        [(text, id_char(token_id)) for text, token_id in vocab.added], "chunk string, whole string"
    )
    size = sum(len(text.encode()) + 32 for text, _ in vocab.added)
    return (
        encoded.join(hinted(added, len(vocab.added), size), "chunk", "left")
        .withColumn("state", F.coalesce("whole", "state"))
        .drop("whole")
    )
