"""Token ids, counts and the way back to text."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.alphabet import byte_chars
from tokenloom.functions.codes import ids_of_state
from tokenloom.operators.blocks import ids_by_blocks
from tokenloom.operators.dictionary import (
    Dictionary,
    build_dictionary,
    occurrences,
    with_codes,
)
from tokenloom.operators.encode import encode_chunks, text_state
from tokenloom.operators.vocabulary import Vocabulary
from tokenloom.plans.parallel import lies_together
from tokenloom.plans.sizes import hinted


def tokenize(
    corpus: DataFrame,
    vocab: Vocabulary,
    key: Sequence[str] = ("doc_id",),
    dictionary: Dictionary | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key.., keep.., ids, n_tokens, ok) of every row; rows of one key are rows of their own.

    A text that could not be encoded, because it is null or has a chunk the
    given dictionary lacks, has no ids and ``ok`` false.

    A vocabulary with few merges encodes each row where it stands. With any
    other, each distinct chunk is encoded once and joined back; over a corpus
    bucketed by key the last gather then needs no shuffle. A dictionary too large
    to broadcast is joined with the distinct chunks of blocks of texts.
    """
    if dictionary is None and vocab.literal_merges is not None:
        return encode_inline(corpus, vocab, [*key, *keep])
    dictionary = dictionary or build_dictionary(corpus, vocab)
    if not dictionary.fits:
        return ids_by_blocks(corpus, vocab, dictionary, [*key, *keep])
    given = corpus.withColumn("given", F.col("text").isNotNull()).withColumns(marks(F.col("text")))
    rows = occurrences(given, [*key, *MARKS, "given"], vocab, keep_blank=True)
    tokens = gathered(with_codes(rows, dictionary, ["state"]), key)
    if not keep:
        return repeated(tokens, [*key, "ids", "n_tokens", "ok"])
    # Null keys are keys too.
    same = [F.col(f"c.{name}").eqNullSafe(F.col(f"t.{name}")) for name in [*key, *MARKS]]
    joined = given.select(*key, *keep, *MARKS).alias("c").join(tokens.alias("t"), same)
    return joined.select(*(f"c.{name}" for name in [*key, *keep]), "ids", "n_tokens", "ok")


def encode_inline(corpus: DataFrame, vocab: Vocabulary, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`tokenize` without any shuffle, on tables and streams, for a literal vocabulary."""
    if vocab.literal_merges is None:
        raise ValueError("this vocabulary has too many merges, or unordered ones, to encode inline")
    state = F.coalesce(text_state(vocab, F.col("text")), F.lit(""))
    rows = corpus.select(*key, state.alias("state"), F.col("text").isNotNull().alias("ok"))
    return _with_ids(rows, key)


def _with_ids(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.select(
        *key, ids_of_state(F.col("state")).alias("ids"), F.char_length("state").alias("n_tokens"), "ok"
    )


# A 64-bit hash of what a row holds: it tells rows of one key apart, however often the rows are read.
MARKS = ("_content",)


def marks(content: Column) -> dict[str, Column]:
    return {"_content": F.xxhash64(content)}


RUN = "struct<n: int, text: string>"


def run_joiner():
    """A function that joins the texts of consecutive positions of a row where they stand.

    The first row of a run gets the number of its rows and their text, the others null. Runs
    end with a batch at the latest; rows in another order only give more runs. The text of a
    run already lies in one piece, so only its bounds are computed.

    It is made here so that it travels with the task: executors need not have this package.
    """

    def join(mark: pa.Array, pos: pa.Array, text: pa.Array) -> pa.Array:
        size = len(text)
        given = (pos.is_valid().to_numpy(zero_copy_only=False)) & (text.is_valid().to_numpy(zero_copy_only=False))
        marks, places, text = mark.to_numpy(zero_copy_only=False), pos.fill_null(0).to_numpy(zero_copy_only=False), text.fill_null("")
        first = np.ones(size, bool)
        first[1:] = ~(given[1:] & given[:-1] & (marks[1:] == marks[:-1]) & (places[1:] == places[:-1] + 1))
        ends = np.append(np.flatnonzero(first), size)
        offsets = np.zeros(1, np.int32)
        if size:
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + size + 1]
        bounds = offsets[ends[np.searchsorted(ends, np.arange(size + 1))]]
        joined = pa.StringArray.from_buffers(size, pa.py_buffer(bounds.tobytes()), text.buffers()[2] or pa.py_buffer(b""))
        counts = np.zeros(size, np.int32)
        counts[ends[:-1]] = np.diff(ends)
        return pa.StructArray.from_arrays([pa.array(counts), joined], names=["n", "text"], mask=pa.array(~(first & given)))

    # What ends a run depends on the batches.
    return F.arrow_udf(join, RUN).asNondeterministic()


def put_together(pieces: DataFrame, key: Sequence[str], text: Column, known: Column) -> DataFrame:
    """(key.., ``MARKS``, text, ok, copies): the texts of (key.., ``MARKS``, pos) rows in order, one row for equal rows of one key.

    Runs of positions are joined in each task, so about one row for each row of the corpus
    is sorted and shuffled, not one for each position. ``ok`` tells whether all positions
    are known.
    """
    named = pieces.select(*key, *MARKS, "pos", text.alias("text"), known.alias("known"), F.xxhash64(*key, *MARKS).alias("mark"))
    # Python hides how rows lie; where they need no shuffle, each position is a run of its own.
    alone = F.when(F.col("pos").isNotNull() & F.col("text").isNotNull(), F.struct(F.lit(1).alias("n"), "text"))
    joined = alone if lies_together(named, [*key, *MARKS]) else run_joiner()("mark", "pos", "text")
    runs = named.select(*key, *MARKS, "pos", "known", joined.alias("run"))
    runs = runs.where("run IS NOT NULL OR pos IS NULL OR NOT known")
    run = F.struct("pos", F.col("run.n").alias("n"), F.col("run.text").alias("text"))
    whole = runs.groupBy(*key, *MARKS).agg(
        F.sort_array(F.collect_list(F.when(F.col("run").isNotNull(), run))).alias("runs"), F.bool_and("known").alias("ok"), copies().alias("copies")
    )
    nothing = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("texts"))

    def follow(read: Column, r: Column) -> Column:
        longer = F.struct((r["pos"] + r["n"]).alias("next"), F.concat(read["texts"], F.array(r["text"])).alias("texts"))
        return F.when(r["pos"] == read["next"], longer).otherwise(read)

    # Runs of equal rows of one key may be cut at different positions; one way from start to end is followed.
    once = F.aggregate("runs", nothing, follow)["texts"]
    texts = F.when(F.col("copies") > 1, once).otherwise(F.col("runs.text"))
    return whole.select(*key, *MARKS, F.array_join(texts, "").alias("text"), "ok", "copies")


def copies() -> Column:
    """How many equal rows were gathered into one."""
    return F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0)


def repeated(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(*columns)


def gathered(pieces: DataFrame, key: Sequence[str]) -> DataFrame:
    """Put (key.., ``MARKS``, given, pos, chunk, state) rows together in order: one row for equal rows of one key, with ``copies``."""
    known = F.col("given") & (F.col("state").isNotNull() | F.col("chunk").isNull())
    whole = put_together(pieces, key, F.col("state"), known)
    state = F.when(F.col("ok"), F.col("text")).otherwise(F.lit(""))
    return _with_ids(whole.select(*key, *MARKS, "copies", state.alias("state"), "ok"), [*key, *MARKS, "copies"])


def token_counts(
    corpus: DataFrame,
    vocab: Vocabulary,
    by: Sequence[str],
    dictionary: Dictionary | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """(by.., n_tokens) without building any id array.

    With ``few_groups``, for groupings such as a language, chunks are counted
    and encoded once per group: the text is read once and only distinct
    (group, chunk) pairs are shuffled. For other groupings a vocabulary with
    few merges counts each row where it stands; with any other, each distinct
    chunk is encoded once and only its count goes back onto the occurrences,
    which are summed before they are shuffled.
    """
    if dictionary is None and few_groups:
        chunks = occurrences(corpus, by, vocab, keep_blank=True).groupBy(*by, "chunk").agg(F.count("*").alias("n"))
        encoded = encode_chunks(chunks, vocab)
        counted = encoded.withColumn("n_tokens", F.col("n_tokens") * F.col("n"))
    elif dictionary is None and vocab.literal_merges is not None:
        size = F.char_length(text_state(vocab, F.col("text")))
        counted = corpus.select(*by, size.alias("n_tokens"))
    else:
        dictionary = dictionary or build_dictionary(corpus, vocab)
        rows = occurrences(corpus, by, vocab, keep_blank=True).drop("pos")
        counted = with_codes(rows, dictionary, ["n_tokens"])
    # A group whose texts are all empty counts 0.
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))


def pair_counts(dictionary: Dictionary) -> DataFrame:
    """How often two ids stand side by side within a chunk, over the whole corpus.

    Pairs never cross a chunk, so the dictionary and its frequencies suffice.
    """
    ids = ids_of_state(F.col("state"))
    rows = dictionary.table.where("n_tokens > 1").select("n", "n_tokens", ids.alias("ids"))
    pairs = rows.select(
        "n",
        F.explode(
            F.arrays_zip(
                F.slice("ids", F.lit(1), F.col("n_tokens") - 1).alias("left_id"),
                F.slice("ids", F.lit(2), F.col("n_tokens") - 1).alias("right_id"),
            )
        ).alias("pair"),
    )
    return pairs.groupBy("pair.left_id", "pair.right_id").agg(F.sum("n").alias("n"))


def oov_bytes(text: Column, vocab: Vocabulary) -> Column:
    """Number of bytes of a text that the vocabulary has no token for."""
    unknown = "".join(chr(b) for b in vocab.unknown_bytes)
    if not unknown:
        return F.when(text.isNotNull(), F.lit(0))
    kept = F.translate(byte_chars(text), unknown, "")
    return F.octet_length(text) - F.char_length(kept)


def _text(spelled: Column) -> Column:
    """The text of hex bytes; null where they are no whole characters, as in a cut id list."""
    return F.try_validate_utf8(F.unhex(spelled).cast("string"))


def _read_inline(ids: Column, tokens: Sequence[str]) -> Column:
    listed = F.split(F.lit(",".join(tokens)), ",")

    def token(token_id: Column) -> Column:
        return F.when(token_id >= 0, F.nullif(F.try_element_at(listed, token_id + 1), F.lit("")))

    parts = F.transform(F.coalesce(ids, F.array().cast("array<int>")), token)
    text = _text(F.array_join(parts, ""))
    return F.when(~F.exists(parts, lambda part: part.isNull()), text)


def detokenize(tokens: DataFrame, vocab: Vocabulary, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(key.., text) from ids.

    An id outside the vocabulary makes the text null, and so do ids that end or
    begin within a character.

    With few tokens each row is read where it stands; with many, ids are
    joined to the vocabulary and gathered by key.
    """
    if vocab.literal_tokens is not None:
        return tokens.select(*key, _read_inline(F.col("ids"), vocab.literal_tokens).alias("text"))
    marked = tokens.withColumns(marks(F.col("ids")))
    rows = marked.select(*key, *MARKS, F.posexplode_outer("ids").alias("pos", "id"))
    lookup = vocab.tokens.select("id", "tok_hex", F.lit(True).alias("known"))
    size = lookup.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("tok_hex") + 32), F.lit(0)).alias("bytes")).first()
    joined = rows.join(hinted(lookup, size["rows"], size["bytes"]), "id", "left")
    whole = put_together(joined, key, F.col("tok_hex"), F.col("known").isNotNull() | F.col("pos").isNull())
    return repeated(whole.withColumn("text", F.when(F.col("ok"), _text(F.col("text")))), [*key, "text"])
