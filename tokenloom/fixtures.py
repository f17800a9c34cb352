"""A small vocabulary for examples, tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.chunks import DEFAULT_PATTERN
from tokenloom.operators.vocabulary import Vocabulary, build_vocabulary, load_vocabulary
from tokenloom.sources.vocab import merges_from_arrays, typed_tokens_from_arrays

# 64 merges in rank order, hex of the raw bytes, left+right.
# Ids 0-255 are the single bytes; the merge of rank r makes id 256 + r.
MERGES_64 = """
74+68 20+65 20+7468 6F+6E 69+6E 72+65 20+61 74+69
68+65 65+72 6E+64 6C+65 20+6F 20+C3 65+6E 63+68
73+74 207468+65 61+6E 2065+72 7469+6F6E 20+64 68+61 20+6F6E
6F+75 2065+6E 6C+79 6F+72 696E+67 61+74 6E+74 62+6C65
65+61 77+68 65+73 63+69 73+68 2061+6E C3+B3 75+65
206F+66 20+7265 20+696E 20C3+A9 6369+C3B3 69+74 69+65 65+64
20+74 6369C3B3+6E 20+6865 71+7565 75+78 656E+74 C3+A9 20+6C
2061+6E64 6D+656E74 21+21 25+25 2A+2A 2064+65 26+26 24+24
""".split()

# Tokens added to the 64-merge vocabulary.
END_OF_TEXT = ("<|endoftext|>", 320)
USER = ("<|user|>", 321)

# A published byte-level BPE file with 50,000 merges.
LARGE_FILE = "byte_bpe_50k.json"

_vocabularies: dict[tuple, Vocabulary] = {}


def spelled(raw: bytes) -> str:
    """Bytes in the byte alphabet."""
    shifted = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return "".join(chr(256 + shifted.index(b)) if b in shifted else chr(b) for b in raw)


def model_arrays(spark: SparkSession, merges: list[str] = MERGES_64, added: tuple = ()) -> DataFrame:
    """One model as arrays: tokens, merges and token types, by position."""
    merged = [bytes.fromhex(m.replace("+", "")) for m in merges]
    tokens = [spelled(t) for t in [bytes([b]) for b in range(256)] + merged]
    types = [1] * len(tokens)
    for text, token_id in added:
        # Ids between the merges and the added tokens are unused.
        tokens += [f"<|unused{i}|>" for i in range(len(tokens), token_id)] + [text]
        types += [3] * (len(tokens) - len(types))
    pairs = [" ".join(spelled(bytes.fromhex(side)) for side in m.split("+")) for m in merges]
    arrays = {"tokens": tokens, "merges": pairs, "token_types": types}
    return spark.range(1).select(
        *[F.array(*map(F.lit, values)).alias(name) for name, values in arrays.items()],
        F.lit(None).cast("array<float>").alias("scores"),
    )


def raw_tokens(spark: SparkSession, merges: list[str] = MERGES_64, added: tuple = ()) -> DataFrame:
    return typed_tokens_from_arrays(model_arrays(spark, merges, added))


def raw_merges(spark: SparkSession, merges: list[str] = MERGES_64) -> DataFrame:
    return merges_from_arrays(model_arrays(spark, merges))


def vocabulary_64(spark: SparkSession, n_merges: int = 64, added: tuple = ()) -> Vocabulary:
    """The vocabulary with its first ``n_merges`` merges, built once per session."""
    key = (spark.sparkContext.applicationId, n_merges, added)
    if key not in _vocabularies:
        merges = MERGES_64[:n_merges]
        _vocabularies[key] = build_vocabulary(
            raw_tokens(spark, merges, added), raw_merges(spark, merges), added=added
        )
    return _vocabularies[key]


def large_file() -> str:
    """Where the file of 50,000 merges lies."""
    import public_tokenizers

    return public_tokenizers.path(LARGE_FILE)


def vocabulary_of_file(spark: SparkSession, path: str, pattern: str = DEFAULT_PATTERN) -> Vocabulary:
    """The vocabulary of a tokenizer.json file, loaded once per session."""
    key = (spark.sparkContext.applicationId, path, pattern)
    if key not in _vocabularies:
        _vocabularies[key] = load_vocabulary(spark, path, pattern)
    return _vocabularies[key]
