"""Quality rules: how far a document's histograms diverge from those of its language.

Two histograms are taken from each text: of character classes, and of the common
words of every language with one bin for all other words. Each is compared with the
references by Jensen-Shannon distance (base 2, 0 to 1), and the nearest language
counts, so a label of the wrong language rejects nothing. A text under the minimum
length has too few counts to compare, and a document of a language without a reference
has nothing to be compared with: neither is rejected by divergence.

References are fitted on all documents labelled good, for the ``LANGUAGES`` languages that
have most. How far common
words may diverge comes from the same documents: shorter texts diverge more, so for each
doubling of the length the bound lies half-way between the ``QUANTILE`` of the good
documents' own distances and the distance of a text of unknown words. A length with fewer
than ``LEAST_IN_OCTAVE`` good documents takes the bound of the next shorter one.
Everything else covers every document in full.

Nulls and odd input: a null text is an empty one and has no words; a document with a
null or unlabelled id is measured like any other and only never serves for fitting;
a null language is a language of its own; without references (no labels, empty table)
divergence rejects nothing. Rows are never merged: a repeated row gives repeated
results. Other columns are kept or ignored as the caller asks, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tokenloom.llm.arrow import Texts, map_texts, quoted, unused
from tokenloom.llm.words import WIDTH, Words, span_hashes, windows
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written

LANGUAGES = 200
QUANTILE = 0.995
LEAST_IN_OCTAVE = 30
TOP_WORDS = 100
MIN_SAMPLE = 5  # documents
MIN_WORDS = 40
MAX_CLASS_DISTANCE = 0.16

LEAST_WORDS = 10
REPEATED_PERCENT = 20

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "space", "mark", "symbol", "other")


def _class_table() -> np.ndarray:
    table = np.full(256, 4, np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = -1  # numbers are of no language
    table[[9, 10, 11, 12, 13, 32]] = 2
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 3
    table[0x80:0xC0] = -1  # continuation bytes are no characters of their own
    table[0xC0:] = 5
    return table


_CLASS = _class_table()
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1


OCTAVES = 64


@dataclass(frozen=True)
class References:
    """Histograms of each language: characters by class, and words (the last bin: any other).

    ``bounds``: the largest word distance of a text with 1, 2-3, 4-7, ... words.
    """

    languages: tuple[str, ...]
    classes: np.ndarray
    hashes: np.ndarray
    words: np.ndarray
    bounds: np.ndarray = field(default_factory=lambda: np.full(OCTAVES, np.inf))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[offsets])


def _owner(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: is its hash found twice or more in its text, and is it an earlier one's copy."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(hashes), bool)
    a, b = order[:-1], order[1:]
    same[1:] = (hashes[a] == hashes[b]) & (owner[a] == owner[b])
    twice = same.copy()
    twice[:-1] |= same[1:]
    again, copies = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order], copies[order] = twice, same
    return again, copies


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    words = Words(texts)
    data, offsets, counts = texts.data, texts.offsets, words.counts
    character = (data & 0xC0) != 0x80

    windowed, per_text = windows(words.hashes(), counts)
    again, _ = _repeated(_owner(per_text), windowed)
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts - (np.cumsum(per_text) - per_text), per_text) + np.arange(len(windowed))
    steps = np.zeros(int(counts.sum()) + WIDTH + 1, np.int64)
    np.add.at(steps, at[again], 1)
    np.add.at(steps, at[again] + WIDTH, -1)
    covered = np.cumsum(steps)[: int(counts.sum())] > 0

    cuts = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], cuts + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.concatenate([line_starts[1:], [len(data)]])
    line_ends = line_ends - (data[line_ends - 1] == 10) if len(data) else line_ends[:0]
    inside = np.concatenate([[0], np.cumsum(words.inside)])
    filled = inside[line_ends] > inside[line_starts]
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    owner = np.searchsorted(offsets, line_starts, "right") - 1
    _, copies = _repeated(owner, span_hashes(data, line_starts, line_ends))

    return {
        "n_words": counts.astype(np.int64),
        "word_chars": _sums(character & words.inside, offsets),
        "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(owner[copies], minlength=len(texts)).astype(np.int64),
        "n_repeat_words": _sums(covered, np.concatenate([[0], np.cumsum(counts)])),
    }


def class_histograms(texts: Texts) -> np.ndarray:
    kinds = _CLASS[texts.data]
    owner = _owner(np.diff(texts.offsets))
    real = kinds >= 0
    flat = np.bincount(owner[real] * len(CLASSES) + kinds[real], minlength=len(texts) * len(CLASSES))
    return flat.reshape(len(texts), len(CLASSES))


def word_histograms(texts: Texts, hashes: np.ndarray) -> np.ndarray:
    """Occurrences of each of the sorted ``hashes`` among a text's lower-cased words, then of all others.

    Marks at a word's end are no part of it.
    """
    bins = len(hashes) + 1
    words = Words(texts, lower=True)
    starts, ends = words.starts, words.ends
    closing = (_CLASS[words.data[ends - 1]] == 3) & (ends - starts > 1) if len(ends) else np.zeros(0, bool)
    own = span_hashes(words.data, starts, ends - closing)
    at = np.searchsorted(hashes, own)
    if len(hashes):
        known = hashes[np.minimum(at, len(hashes) - 1)] == own
    else:
        known = np.zeros(len(own), bool)
    at = np.where(known, at, len(hashes))
    flat = np.bincount(_owner(words.counts) * bins + at, minlength=len(texts) * bins)
    return flat.reshape(len(texts), bins)


def nearest_distance(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The least Jensen-Shannon distance of each row of counts to a reference; 0 for a row without counts."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    best = np.full(len(counts), np.inf)
    for q in references:
        m = (p + q) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
            right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
        best = np.minimum(best, np.sqrt(np.maximum(left + right, 0) / 2))
    return np.where(total[:, 0] > 0, np.where(np.isinf(best), 0, best), 0)


def _labelled_good(docs: DataFrame, labels: DataFrame, key: str, text: str, language: str) -> DataFrame:
    """Language and text of every document labelled good, of the ``LANGUAGES`` languages that have most. The result is stored."""
    lang = F.coalesce(quoted(language), F.lit(""))
    named = docs.select(quoted(key).alias("id"), lang.alias("lang"), quoted(text).alias("text")).where("id IS NOT NULL")
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    n_good = good.count()
    found = written(named.join(hinted(good, n_good, 16 * n_good), "id").select("lang", "text"), "good-documents")
    most = found.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    # At most ``LANGUAGES`` names are broadcast.
    return found.join(F.broadcast(most), "lang")


def word_bounds(good: DataFrame, references: References) -> np.ndarray:
    """The largest word distance for each doubling of the length, from the good documents' own distances."""

    def measured(part):
        texts = Texts(part.column("text"))
        distance = nearest_distance(word_histograms(texts, references.hashes), references.words)
        return [pa.array(_octave(Words(texts).counts)), pa.array(distance)]

    found = map_texts(good, "text", measured, "octave int, distance double").groupBy("octave")
    upper = F.percentile_approx("distance", QUANTILE, 100_000).alias("upper")
    rows = {r["octave"]: r for r in found.agg(F.count("*").alias("n"), upper).collect()}
    only_other = np.zeros((1, references.words.shape[1]))
    only_other[0, -1] = 1
    unknown = float(nearest_distance(only_other, references.words)[0])
    bounds, last = np.full(OCTAVES, np.inf), np.inf
    for k in range(OCTAVES):
        if k in rows and rows[k]["n"] >= LEAST_IN_OCTAVE:
            last = max(rows[k]["upper"], (rows[k]["upper"] + unknown) / 2)
        bounds[k] = last
    return bounds


def _octave(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int32)


def fit_references(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
) -> References:
    """References of the languages that have at least ``MIN_SAMPLE`` documents labelled good.

    The driver gets a few hundred counts for each of them, and one bound for each doubling of the length.
    """
    chosen = _labelled_good(docs, labels, key, text, language)

    def classes(part):
        found = class_histograms(Texts(part.column("text")))
        return [pa.array(found[:, k]) for k in range(len(CLASSES))]

    names = [f"c{k}" for k in range(len(CLASSES))]
    counted = map_texts(chosen, "text", classes, ", ".join(f"{n} long" for n in names), keep=["lang"])
    totals = counted.groupBy("lang").agg(F.count("*").alias("n"), *(F.sum(n).alias(n) for n in names))
    totals = totals.where(F.col("n") >= MIN_SAMPLE).orderBy("lang").collect()
    languages = tuple(r["lang"] for r in totals)

    word = F.regexp_replace(F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"(?<=.)[.,;:!?'\"()-]$", "")
    counts = (
        chosen.where(F.col("lang").isin(*languages))
        .select("lang", F.explode(F.split("text", r"[ \t-\r]+")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", word.alias("word"))
        .count()
    )
    counts = written(counts, "good-words")
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    ranked = counts.withColumn("place", F.row_number().over(order))
    total = counts.groupBy("lang").agg(F.sum("count").alias("total"))
    common = ranked.where(F.col("place") <= TOP_WORDS).select("word").distinct()
    rows = counts.join(common, "word").join(total, "lang").select("lang", "word", "count", "total").collect()

    if not rows:
        return References((), np.zeros((0, len(CLASSES))), np.zeros(0, np.uint64), np.zeros((0, 1)))
    vocabulary = sorted({r["word"] for r in rows})
    spelt = Texts(pa.array(vocabulary))
    own = span_hashes(spelt.data, spelt.offsets[:-1], spelt.offsets[1:])
    order = np.argsort(own)
    place = {vocabulary[k]: n for n, k in enumerate(order)}
    histogram = np.zeros((len(languages), len(vocabulary) + 1))
    for r in rows:
        histogram[languages.index(r["lang"]), place[r["word"]]] = r["count"] / r["total"]
    histogram[:, -1] = 1 - histogram[:, :-1].sum(1)
    shares = np.array([[r[n] for n in names] for r in totals], float)
    found = References(languages, shares / np.maximum(shares.sum(1, keepdims=True), 1), own[order], histogram)
    return replace(found, bounds=word_bounds(chosen, found))


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def judge(
    docs: DataFrame,
    references: References,
    keep: Sequence[str],
    text: str = "text",
    min_words: int = MIN_WORDS,
    only: str | None = None,
    language: str | None = "lang",
) -> DataFrame:
    """Columns ``keep`` of every document, its counts, its distances, and whether it is kept.

    ``only`` names a column for the verdict that then stands alone beside ``keep``.
    Without a column ``language``, every document is compared with the references.
    """
    language = language if language in docs.columns else None
    carried = [*dict.fromkeys([*keep, *([language] if language else [])])]

    def run(part):
        texts = Texts(part.column(text))
        counts = base_counts(texts)
        n, repeated = counts["n_words"], counts["n_repeat_words"]
        failed = (n < LEAST_WORDS) | (100 * repeated > REPEATED_PERCENT * n)
        by_class = nearest_distance(class_histograms(texts), references.classes)
        by_word = nearest_distance(word_histograms(texts, references.hashes), references.words)
        far = (n >= min_words) & ((by_class > MAX_CLASS_DISTANCE) | (by_word > references.bounds[_octave(n)]))
        if language:
            far &= np.array([(own or "") in references.languages for own in part.column(language).to_pylist()], bool)
        measured = [*(pa.array(v) for v in counts.values()), *map(pa.array, (failed, by_class, by_word, ~failed & ~far))]
        return measured[-1:] if only else measured

    verdict = StructType([StructField(only, BooleanType())]) if only else SCHEMA
    judged = map_texts(docs, text, run, verdict, keep=carried)
    dropped = [language] if language and language not in keep else []
    return judged.select(*(quoted(c) for c in judged.columns if c not in dropped))


def judged_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: every document, with references from the labels of the same folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    references = fit_references(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return judge(docs, references, keep=["doc_id"])


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pipeline's stage: documents that pass, with their columns as they were."""
    references = fit_references(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    verdict = unused(docs.columns, "kept")
    return judge(docs, references, keep=docs.columns, only=verdict).where(quoted(verdict)).drop(verdict)
