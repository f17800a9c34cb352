"""Token counts of the fields or sections of a document, from one encoding of the whole.

A text is encoded once. Every token has a span of code points: from the character its
first byte belongs to up to the end of the one its last byte belongs to. Sections are
spans too. Both are in order, so two binary searches per section find the tokens that
overlap it; those inside count one, and a token that crosses a boundary is allocated
by one of these rules:

- ``first``: to the section that holds its first character,
- ``last``: to the section that holds its last character,
- ``share``: to each section by the share of its characters that lie there.

Over sections that cover a text without overlap, each rule's counts add up to the
text's tokens. Sections may also overlap or leave gaps; each is counted for itself.

Nulls and odd input: a null text is empty and has one empty section when split into
lines. Null sections are none. A span is clipped to the text; an empty one has no
tokens. Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe
from tokenloom.llm.arrow import map_texts, quoted, unused

RULES = ("first", "last", "share")

Spans = tuple[np.ndarray, np.ndarray]


def line_sections(text: str) -> Spans:
    """The lines of a text, each with the \\n that ends it."""
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")])
    ends[-1] -= 1
    return np.concatenate([[0], ends[:-1]]), ends


def token_spans(text: str, path: str, sizes: np.ndarray) -> Spans:
    """First character and end of every token, in code points."""
    ids = np.array(bpe.encode(path, text), np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    raw = text.encode("utf-8")
    if len(raw) == len(text):
        return starts, ends
    data = np.frombuffer(raw, np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
    return character[starts], character[ends - 1] + 1


def allocate(tokens: Spans, sections: Spans, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many of those it overlaps cross one of its ends."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    a, b = tokens
    start, end = sections
    low = np.searchsorted(b, start, "right")  # the first token that ends after the section's start
    high = np.maximum(np.searchsorted(a, end, "left"), low)  # after the last that starts before its end
    high = np.where(end > start, high, low)
    # Tokens that share a character (parts of its bytes) start at the same place, so runs count as one by one.
    left = np.minimum(np.maximum(np.searchsorted(a, start, "left"), low), high)
    right = np.maximum(np.minimum(np.searchsorted(b, end, "right"), high), low)
    crossing = (left - low) + (high - right) - np.maximum(left - right, 0)
    if rule == "first":
        return (high - left).astype(float), crossing
    if rule == "last":
        return (right - low).astype(float), crossing
    counts = np.maximum(right - left, 0).astype(float)
    for n in np.flatnonzero(crossing):
        for t in {*range(low[n], left[n]), *range(right[n], high[n])}:
            counts[n] += (min(b[t], end[n]) - max(a[t], start[n])) / (b[t] - a[t])
    return counts, crossing


SCHEMA = "{} array<struct<section: int, start: long, end: long, n_tokens: double, n_crossing: long>>"


def attribute_tokens(
    docs: DataFrame,
    path: str,
    keep: Sequence[str],
    text: str = "text",
    sections: str | Callable[[str], Spans] = line_sections,
    rule: str = "first",
) -> DataFrame:
    """Columns ``keep``, then one row per section: its number, span, tokens, and tokens across its ends.

    ``sections`` is a function of the text, or a column of array<struct<start, end>>
    in order of the starts.
    """
    by_column = isinstance(sections, str)

    def run(part):
        sizes = _token_sizes(path)
        given = part.column(sections).to_pylist() if by_column else [None] * part.num_rows
        found = []
        for text_value, own in zip(part.column(text).to_pylist(), given, strict=True):
            value = text_value or ""
            if by_column:
                pairs = np.array([(s["start"], s["end"]) for s in own or []], np.int64).reshape(-1, 2)
                spans = np.clip(pairs[:, 0], 0, len(value)), np.clip(pairs[:, 1], 0, len(value))
            else:
                spans = sections(value)
            found.append((*spans, *allocate(token_spans(value, path, sizes), spans, rule)))
        counts = [len(f[0]) for f in found]
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        number = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], counts)
        columns = [np.concatenate([*(f[k] for f in found), np.zeros(0, np.int64)]) for k in range(4)]
        arrays = [
            pa.array(number.astype(np.int32)),
            pa.array(columns[0].astype(np.int64)),
            pa.array(columns[1].astype(np.int64)),
            pa.array(columns[2].astype(float)),
            pa.array(columns[3].astype(np.int64)),
        ]
        structs = pa.StructArray.from_arrays(arrays, ["section", "start", "end", "n_tokens", "n_crossing"])
        return [pa.ListArray.from_arrays(pa.array(offsets), structs)]

    carried = [*dict.fromkeys([*keep, *([sections] if by_column else [])])]
    counted = map_texts(docs, text, run, SCHEMA.format(unused(carried, "found")), keep=carried)
    return counted.select(*(quoted(c) for c in keep), F.inline(counted.columns[-1]))


@lru_cache(maxsize=4)
def _token_sizes(path: str) -> np.ndarray:
    return np.array([len(t) for t in bpe.read_byte_bpe(path).tokens], np.int64)


def joined_fields(fields: Sequence[Column], separator: str = "\n") -> tuple[Column, Column]:
    """A text made of several fields (null: empty), and the section of each field in it.

    Separators belong to the field before them.
    """
    values = [F.coalesce(f, F.lit("")) for f in fields]
    sizes = [F.length(v) + (len(separator) if n < len(values) - 1 else 0) for n, v in enumerate(values)]
    starts = [F.lit(0)]
    for size in sizes:
        starts.append(starts[-1] + size)
    spans = [F.struct(a.alias("start"), b.alias("end")) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return F.concat_ws(separator, *values), F.array(*spans)


def line_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The query: the tokens of every line of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    counted = attribute_tokens(docs, bpe.default_path(), ["doc_id"])
    return counted.select("doc_id", "section", "start", "end", F.col("n_tokens").cast("long").alias("n_tokens"), "n_crossing")
