"""One vocabulary, resolved and ready to encode with."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.alphabet import byte_chars, hex_chars, token_hex
from tokenloom.functions.chunks import DEFAULT_PATTERN
from tokenloom.functions.codes import MAX_ID, char_of_id, id_char
from tokenloom.operators.vocab_tables import (
    SPECIAL,
    byte_tokens,
    first_ids,
    merge_order,
    resolve_merges,
    token_table,
    validate_merges,
)
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written
from tokenloom.sources.vocab import (
    merges_from_arrays,
    read_tokenizer_json,
    tokens_from_json,
)

# Up to this many merges an ordered table is applied as one literal list.
LITERAL_MERGES = 256
# Ids below this make a literal list of token bytes.
LITERAL_TOKENS = 4096
# How many characters of a long span are looked up before the whole span is.
HEAD = 4
# Up to this many added tokens are applied as literals where a text stands.
LITERAL_ADDED = 256


@dataclass(frozen=True)
class Vocabulary:
    """Tables of a vocabulary and the small facts plans are chosen by.

    ``tokens``: (id, token, tok_hex, token_type, score).
    ``merges``: (rank, left_id, right_id, merged_id, pattern, result, span);
    ``pattern`` and ``result`` are written one character per token and ``span``,
    the bytes of the merged token, one character per byte token.
    ``heads``: (head, lengths), ``n_heads`` rows: the first two characters of spans with
    the lengths of what starts so, ``HEAD`` standing for it and all above; and the first
    ``HEAD`` characters of longer spans with every length of what starts so.
    ``literal_merges`` and ``literal_tokens`` (hex by id, empty for an unused
    id) are there only for vocabularies small enough to be part of a plan.
    """

    tokens: DataFrame
    merges: DataFrame
    heads: DataFrame
    n_heads: int
    byte_ids: tuple[int, ...]
    unknown_bytes: tuple[int, ...]
    n_merges: int
    span_bytes: int
    max_span: int
    in_order: bool
    literal_merges: tuple[tuple[str, str], ...] | None
    literal_tokens: tuple[str, ...] | None
    pattern: str = DEFAULT_PATTERN
    added: tuple[tuple[str, int], ...] = ()
    by: tuple[str, ...] = ()

    @property
    def added_texts(self) -> tuple[str, ...]:
        return tuple(text for text, _ in self.added)

    def start_state(self, chunk):
        """A chunk before any merge: one character per byte token."""
        every_byte = "".join(chr(b) for b in range(256))
        start = "".join(id_char(i) for i in self.byte_ids)
        return F.translate(byte_chars(chunk), every_byte, start)

    def with_start(self, chunks: DataFrame) -> DataFrame:
        return chunks.withColumn("start_state", self.start_state(F.col("chunk")))

    def hinted_merges(self, *columns: str) -> DataFrame:
        return hinted(self.merges.select(*columns), self.n_merges, 4 * self.span_bytes)


def build_vocabulary(
    tokens: DataFrame,
    merges: DataFrame,
    pattern: str = DEFAULT_PATTERN,
    added: Sequence[tuple[str, int]] = (),
) -> Vocabulary:
    """Resolve raw tables and store them.

    ``tokens``: (id, token, source_type, score); ``merges``: (rank, left, right);
    both spelled in the byte alphabet.
    """
    table = written(token_table(tokens), "tokens")
    lookup = first_ids(table)
    spelled = merges.select(
        "rank", token_hex(F.col("left")).alias("left"), token_hex(F.col("right")).alias("right")
    )
    resolved = merge_order(resolve_merges(spelled, lookup))

    # At most 256 rows, one per byte value.
    known = {r["byte"]: r["id"] for r in byte_tokens(table).collect()}
    largest = table.agg(F.max("id")).first()[0]
    if largest is not None and largest > MAX_ID:
        raise ValueError(f"token id {largest} is above {MAX_ID}")
    byte_ids = tuple(known.get(b, 0) for b in range(256))
    start = "".join(id_char(i) for i in byte_ids)
    every_byte = "".join(chr(b) for b in range(256))

    spans = resolved.join(
        table.select(F.col("id").alias("merged_id"), F.col("tok_hex")), "merged_id"
    ).select(
        "rank",
        "left_id",
        "right_id",
        "merged_id",
        F.concat(char_of_id(F.col("left_id")), char_of_id(F.col("right_id"))).alias("pattern"),
        char_of_id(F.col("merged_id")).alias("result"),
        F.translate(hex_chars(F.col("tok_hex")), every_byte, start).alias("span"),
        "in_order",
    )
    ready = written(spans, "spans")
    heads = written(span_heads(ready), "heads")
    facts = ready.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("span") + 32), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.char_length("span")), F.lit(2)).alias("longest"),
        F.coalesce(F.bool_and("in_order"), F.lit(True)).alias("in_order"),
    ).first()
    literal = None
    if facts["in_order"] and facts["n"] <= LITERAL_MERGES and len(added) <= LITERAL_ADDED:
        ranked = ready.orderBy("rank").select("pattern", "result").collect()
        literal = tuple((r["pattern"], r["result"]) for r in ranked)
    literal_tokens = None
    if largest is not None and largest < LITERAL_TOKENS:
        texts = {r["id"]: r["tok_hex"] for r in table.select("id", "tok_hex").collect()}
        literal_tokens = tuple(texts.get(i, "") for i in range(largest + 1))
    return Vocabulary(
        tokens=table,
        merges=ready.drop("in_order"),
        heads=heads,
        n_heads=heads.count(),
        byte_ids=byte_ids,
        unknown_bytes=tuple(b for b in range(256) if b not in known),
        n_merges=facts["n"],
        span_bytes=facts["bytes"],
        max_span=max(2, facts["longest"]),
        in_order=facts["in_order"],
        literal_merges=literal,
        literal_tokens=literal_tokens,
        pattern=pattern,
        added=tuple(added),
    )


def span_heads(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., head, lengths): beginnings of spans, as `Vocabulary.heads` describes them."""
    size = F.char_length("span")

    def lengths(start: int, of: Column) -> DataFrame:
        found = F.sort_array(F.collect_set(of)).alias("lengths")
        return spans.where(size >= start).groupBy(*by, F.left("span", F.lit(start)).alias("head")).agg(found)

    return lengths(2, F.least(size, F.lit(HEAD))).union(lengths(HEAD, size))


def validate_vocabulary(tokens: DataFrame, merges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Problems of raw tables as rows (by.., problem, place); ``place`` is an id or a rank.

    Repeated token texts, then what `validate_merges` finds.
    """
    table = token_table(tokens, by)
    lookup = written(first_ids(table, by), "ids")
    repeated = (
        table.groupBy(*by, "tok_hex")
        .agg(F.count("*").alias("listed"), F.min("id").alias("place"))
        .where("listed > 1")
        .select(*by, F.lit("repeated token").alias("problem"), "place")
    )
    spelled = merges.select(
        *by, "rank", token_hex(F.col("left")).alias("left"), token_hex(F.col("right")).alias("right")
    )
    return repeated.unionByName(validate_merges(spelled, lookup, by).withColumnRenamed("rank", "place"))


def load_vocabulary(spark: SparkSession, path: str, pattern: str | None = None) -> Vocabulary:
    """The vocabulary of one tokenizer.json file.

    Without ``pattern``, the file's own is used, with Unicode character classes
    as such files mean them, or the default if it has no pre-tokenizer.
    """
    parsed = read_tokenizer_json(spark, path)
    found = parsed.select("model_path", "pattern", "error").take(2)
    if len(found) != 1:
        raise ValueError(f"{path}: expected one tokenizer.json file")
    if found[0]["error"]:
        raise ValueError(f"{path}: {found[0]['error']}")
    if pattern is None:
        pattern = f"(?U){found[0]['pattern']}" if found[0]["pattern"] else DEFAULT_PATTERN
    tokens = tokens_from_json(parsed)
    # A part of one vocabulary, which has at most as many ids as there are characters.
    special = tokens.where(F.col("source_type") == 3).select("token", "id").collect()
    added = sorted((r["token"], r["id"]) for r in special)
    return build_vocabulary(tokens, merges_from_arrays(parsed), pattern, added)


def special_tokens(vocab: Vocabulary) -> DataFrame:
    return vocab.tokens.where(F.col("token_type") == SPECIAL)
