"""Tokenizing text corpora with Spark."""

from tokenloom.operators.dictionary import build_dictionary, count_chunks
from tokenloom.operators.encode import encode_chunks
from tokenloom.operators.parity import parity, parity_summary
from tokenloom.operators.requests import build_count_requests, build_requests, build_tokenize_requests
from tokenloom.operators.tokens import detokenize, encode_inline, pair_counts, token_counts, tokenize
from tokenloom.operators.vocab_tables import validate_merges
from tokenloom.operators.vocabulary import (
    Vocabulary,
    build_vocabulary,
    load_vocabulary,
    validate_vocabulary,
)
from tokenloom.sources.corpus import read_corpus, stream_corpus
from tokenloom.sources.replies import match_responses, parse_responses
from tokenloom.streaming.encode_stream import encode_batches

__all__ = [
    "Vocabulary",
    "build_count_requests",
    "build_dictionary",
    "build_requests",
    "build_tokenize_requests",
    "build_vocabulary",
    "count_chunks",
    "detokenize",
    "encode_batches",
    "encode_chunks",
    "encode_inline",
    "load_vocabulary",
    "match_responses",
    "pair_counts",
    "parity",
    "parity_summary",
    "parse_responses",
    "read_corpus",
    "stream_corpus",
    "token_counts",
    "tokenize",
    "validate_merges",
    "validate_vocabulary",
]
