"""Tokenizing with many models in one job.

A model's vocabulary is rows of tables keyed by ``model_name``; no model is part of a
plan. Rows of a corpus name their model, distinct (model, chunk) pairs are encoded once,
and the ids go back onto the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.alphabet import byte_chars, hex_chars, token_hex
from tokenloom.functions.chunks import DEFAULT_PATTERN, covering
from tokenloom.functions.codes import MAX_ID, char_of_id, id_char
from tokenloom.functions.ids import with_bos
from tokenloom.operators.dictionary import measured, with_codes
from tokenloom.operators.encode import encode_chunks
from tokenloom.operators.tokens import MARKS, gathered, marks, repeated
from tokenloom.operators.vocab_tables import byte_tokens, first_ids, merge_order, resolve_merges, token_table
from tokenloom.operators.vocabulary import span_heads
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written
from tokenloom.sources.vocab import BYTE_LEVEL_PATTERN, merges_from_arrays, select_metadata, typed_tokens_from_arrays

MODEL = "model_name"

# Published split patterns by the names that metadata gives them.
PRE_PATTERNS = {
    "default": DEFAULT_PATTERN,
    "gpt-2": "(?U)" + BYTE_LEVEL_PATTERN,
    "llama-bpe": (
        r"(?U)(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
        r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    ),
    "qwen2": (
        r"(?U)(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}"
        r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    ),
}

# Source codes of control and user-defined tokens, which are cut out of a text whole.
ADDED_TYPES = (3, 4)

_EVERY_BYTE = "".join(chr(b) for b in range(256))


def _in_bytes_of_model(text: Column) -> Column:
    """Byte characters as the characters of the byte tokens that the column ``start_bytes`` lists."""
    return F.call_function("translate", text, F.lit(_EVERY_BYTE), F.col("start_bytes"))


@dataclass(frozen=True)
class Models:
    """Vocabularies of many models.

    ``facts``: (model_name, pattern, cut, start_bytes, bos_id, add_bos, error), one row
    per model: the split pattern, a pattern of its added tokens (null without any), the
    characters of the 256 byte tokens, and why the model cannot be used, if so.
    ``merges`` and ``heads`` are those of `Vocabulary` with the model's name; ``whole``:
    (model_name, chunk, state) of the added tokens. All are stored, and their sizes known.
    """

    facts: DataFrame
    n_models: int
    fact_bytes: int
    merges: DataFrame
    n_merges: int
    span_bytes: int
    max_span: int
    in_order: bool
    heads: DataFrame
    n_heads: int
    whole: DataFrame
    n_whole: int
    whole_bytes: int
    by: tuple[str, ...] = (MODEL,)
    literal_merges: None = None
    added: tuple = ()

    def hinted_facts(self, *columns: str) -> DataFrame:
        return hinted(self.facts.select(MODEL, *columns), self.n_models, self.fact_bytes)

    def hinted_merges(self, *columns: str) -> DataFrame:
        return hinted(self.merges.select(*columns), self.n_merges, 4 * self.span_bytes)

    def with_start(self, chunks: DataFrame) -> DataFrame:
        joined = chunks.join(self.hinted_facts("start_bytes"), MODEL, "left")
        start = _in_bytes_of_model(byte_chars(F.col("chunk")))
        return joined.withColumn("start_state", start).drop("start_bytes")


def _pattern_of(pre: Column, patterns: Mapping[str, str]) -> Column:
    """The split pattern of a pre-tokenizer's name; a model that names none takes the default."""
    chosen = F.when(pre.isNull(), covering(patterns["default"]))
    for name, pattern in patterns.items():
        chosen = chosen.when(pre == name, covering(pattern))
    return chosen


def _start_bytes(tokens: DataFrame) -> DataFrame:
    """(model_name, start_bytes): the character of each byte's token in byte order; id 0 where there is none."""
    known = byte_tokens(tokens, [MODEL]).groupBy(MODEL).agg(
        F.map_from_entries(F.collect_list(F.struct("byte", char_of_id(F.col("id"))))).alias("known")
    )
    every = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda b: F.coalesce(F.try_element_at("known", b), F.lit(id_char(0))))
    return known.select(MODEL, F.array_join(every, "").alias("start_bytes"))


def _quoted(text: Column) -> Column:
    """A text as a regular expression that matches it alone."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def models_from_metadata(kv: DataFrame, patterns: Mapping[str, str] = PRE_PATTERNS) -> Models:
    """Models from metadata rows (model_name, key, value variant).

    ``pre`` picks the split pattern, control and user-defined tokens become added
    tokens, and ``add_bos`` with a BOS id puts that id first. A model whose ``pre`` has
    no pattern, or that lacks tokens, or has ids too large to encode, cannot be used and
    says why in ``facts.error``.
    """
    by = [MODEL]
    models = written(select_metadata(kv, by), "models")
    raw = written(typed_tokens_from_arrays(models.where("tokens IS NOT NULL"), by), "raw-tokens")
    tokens = written(token_table(raw, by), "tokens")
    start = written(_start_bytes(tokens), "start-bytes")

    added = raw.where(F.col("source_type").isin(*ADDED_TYPES) & (F.col("id") <= MAX_ID)).groupBy(MODEL, F.col("token").alias("chunk"))
    whole = written(added.agg(char_of_id(F.min("id")).alias("state")), "added-tokens")
    longest_first = F.array_sort(F.collect_list(F.struct(-F.char_length("chunk"), "chunk")))
    cuts = whole.groupBy(MODEL).agg(F.array_join(F.transform(longest_first, lambda t: _quoted(t["chunk"])), "|").alias("cut"))

    largest = tokens.groupBy(MODEL).agg(F.max("id").alias("largest"))
    pattern = _pattern_of(F.col("pre"), patterns)
    error = (
        F.when(F.col("largest").isNull(), "no tokens")
        .when(F.col("largest") > MAX_ID, F.concat(F.lit("an id is above "), F.lit(str(MAX_ID))))
        .when(pattern.isNull(), F.concat(F.lit("no pattern for pre-tokenizer: "), "pre"))
    )
    facts = models.select(MODEL, "pre", "bos_id", "add_bos").join(largest, MODEL, "left").join(start, MODEL, "left").join(cuts, MODEL, "left")
    facts = facts.select(MODEL, pattern.alias("pattern"), "cut", "start_bytes", "bos_id", "add_bos", error.alias("error"))
    facts = written(facts.withColumn("start_bytes", F.coalesce("start_bytes", F.lit(id_char(0) * 256))), "model-facts")

    merges = merges_from_arrays(models, by)
    spelled = merges.select(MODEL, "rank", token_hex(F.col("left")).alias("left"), token_hex(F.col("right")).alias("right"))
    resolved = merge_order(resolve_merges(spelled, first_ids(tokens, by), by), by)
    good = facts.where("error IS NULL").select(MODEL, "start_bytes")
    bytes_of = tokens.select(MODEL, F.col("id").alias("merged_id"), "tok_hex")
    spans = resolved.join(bytes_of, [MODEL, "merged_id"]).join(good, MODEL).select(
        MODEL,
        "rank",
        F.concat(char_of_id(F.col("left_id")), char_of_id(F.col("right_id"))).alias("pattern"),
        char_of_id(F.col("merged_id")).alias("result"),
        _in_bytes_of_model(hex_chars(F.col("tok_hex"))).alias("span"),
        "in_order",
    )
    ready = written(spans, "model-spans")
    heads = written(span_heads(ready, by), "model-heads")
    found = ready.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("span") + F.octet_length(MODEL) + 32), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.char_length("span")), F.lit(2)).alias("longest"),
        F.coalesce(F.bool_and("in_order"), F.lit(True)).alias("in_order"),
    ).first()

    def size(table: DataFrame, column: str):
        return table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()

    n_models, cut_bytes = size(facts, "cut")
    n_whole, whole_bytes = size(whole, "chunk")
    return Models(
        facts=facts,
        n_models=n_models,
        fact_bytes=cut_bytes + 1024 * n_models,
        merges=ready,
        n_merges=found["n"],
        span_bytes=found["bytes"],
        max_span=max(2, found["longest"]),
        in_order=found["in_order"],
        heads=heads,
        n_heads=heads.count(),
        whole=whole,
        n_whole=n_whole,
        whole_bytes=whole_bytes + 32 * n_whole,
    )


def _chunks(text: Column) -> Column:
    """Chunks of a text by the columns ``pattern`` and ``cut``, as `functions.chunks.chunk_array` makes them."""

    def split(part: Column) -> Column:
        return F.regexp_extract_all(part, F.col("pattern"), F.lit(0))

    between, found = F.split(text, F.col("cut"), -1), F.regexp_extract_all(text, F.col("cut"), F.lit(0))
    pieces = F.zip_with(between, found, lambda part, token: F.concat(split(part), F.array_compact(F.array(token))))
    return F.when(F.col("cut").isNull(), split(text)).otherwise(F.flatten(pieces))


def _named(chunk: Column) -> Column:
    """A chunk with its model's name before it, one key for the dictionary."""
    return F.when(chunk.isNotNull(), F.concat(F.col(MODEL), F.lit("\0"), chunk))


def tokenize_by_model(corpus: DataFrame, models: Models, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(key.., model_name, ids, n_tokens, ok) of every row of ``corpus`` (key.., model_name, text); rows of one key are rows of their own.

    A null text, and a row whose model is unknown or cannot be used, has no ids and ``ok`` false.
    """
    facts = models.hinted_facts("pattern", "cut", "error")
    marked = corpus.join(facts, MODEL, "left")
    usable = F.col("error").isNull() & F.col("pattern").isNotNull()
    marked = marked.withColumn("given", usable & F.col("text").isNotNull())
    marked = marked.withColumns(marks(F.col("text")))
    rows = marked.select(*key, MODEL, *MARKS, "given", F.posexplode_outer(F.when(F.col("given"), _chunks(F.col("text")))).alias("pos", "chunk"))

    counted = rows.where("chunk IS NOT NULL").groupBy(MODEL, "chunk").agg(F.count("*").alias("n"))
    encoded = encode_chunks(counted, models)
    whole = hinted(models.whole.withColumnRenamed("state", "whole"), models.n_whole, models.whole_bytes)
    encoded = encoded.join(whole, [MODEL, "chunk"], "left").withColumn("state", F.coalesce("whole", "state"))
    named = encoded.select(_named(F.col("chunk")).alias("chunk"), "n", "state", F.char_length("state").alias("n_tokens"))
    dictionary = measured(written(named, "model-dictionary"))

    coded = with_codes(rows.withColumn("chunk", _named(F.col("chunk"))), dictionary, ["state"])
    whole = repeated(gathered(coded, [*key, MODEL]), [*key, MODEL, "ids", "ok"])
    tokens = whole.join(models.hinted_facts("bos_id", "add_bos"), MODEL, "left")
    ids = F.when(F.col("ok"), with_bos(F.col("ids"), F.col("bos_id"), F.col("add_bos"))).otherwise(F.col("ids"))
    return tokens.select(*key, MODEL, ids.alias("ids"), F.size(ids).alias("n_tokens"), "ok")
