"""Vocabulary sources.

Every function takes ``by``, the columns that name a model. It may be empty for
a single model, or hold for example a file path to load many models in one job.
List positions are ids and ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.chunks import normalize_pattern

# The metadata keys a tokenizer needs.
SCALAR_KEYS = {
    "tokenizer.ggml.model": ("model", "string"),
    "tokenizer.ggml.pre": ("pre", "string"),
    "tokenizer.ggml.bos_token_id": ("bos_id", "int"),
    "tokenizer.ggml.eos_token_id": ("eos_id", "int"),
    "tokenizer.ggml.padding_token_id": ("pad_id", "int"),
    "tokenizer.ggml.unknown_token_id": ("unknown_id", "int"),
    "tokenizer.ggml.add_bos_token": ("add_bos", "boolean"),
}
ARRAY_KEYS = {
    "tokenizer.ggml.tokens": ("tokens", "array<string>"),
    "tokenizer.ggml.merges": ("merges", "array<string>"),
    "tokenizer.ggml.token_type": ("token_types", "array<int>"),
    "tokenizer.ggml.scores": ("scores", "array<float>"),
}

# The parts of a tokenizer.json file that are used.
_TOKENIZER_JSON = (
    "model struct<type: string, vocab: map<string, int>, merges: array<string>>,"
    "added_tokens array<struct<id: int, content: string, special: boolean>>"
)


# Fixed value: the published pattern of a byte-level pre-tokenizer that names none.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLACES = 4  # steps of a pre-tokenizer sequence that are looked at; longer ones are not accepted

# Fields of a tokenizer.json file that change ids and are not built here.
UNBUILT = (
    "normalizer",
    "model.ignore_merges",
    "model.continuing_subword_prefix",
    "model.end_of_word_suffix",
    "model.byte_fallback",
)


def named_empty(token: Column, token_id: Column) -> Column:
    """An empty token is called ``[EMPTY_<id>]`` so that every entry has a text."""
    return F.when(token == "", F.concat(F.lit("[EMPTY_"), token_id.cast("string"), F.lit("]"))).otherwise(token)


def split_merge(merge: Column) -> tuple[Column, Column]:
    """Left and right of a merge, cut at the first space that is not its first character."""
    at = F.locate(" ", merge, 2)
    left = F.when(at > 0, F.substring(merge, F.lit(1), at - 1)).otherwise(merge)
    right = F.when(at > 0, F.substring(merge, at + 1, F.char_length(merge))).otherwise(F.lit(""))
    return left, right


def tokens_from_arrays(models: DataFrame, by: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """Token list to rows (by.., id, token); the id is the list position."""
    rows = models.select(*by, F.posexplode(tokens).alias("id", "raw"))
    return rows.select(*by, "id", named_empty(F.col("raw"), F.col("id")).alias("token"))


def merges_from_arrays(models: DataFrame, by: Sequence[str] = (), merges: str = "merges") -> DataFrame:
    """Merge list to rows (by.., rank, left, right); the rank is the list position."""
    rows = models.select(*by, F.posexplode(merges).alias("rank", "merge"))
    left, right = split_merge(F.col("merge"))
    return rows.select(*by, "rank", left.alias("left"), right.alias("right"))


def attributes_from_arrays(
    models: DataFrame, by: Sequence[str] = (), types: str = "token_types", scores: str = "scores"
) -> DataFrame:
    """Token types and scores to rows (by.., id, source_type, score), aligned by position.

    Either list may be missing or shorter than the other.
    """
    pairs = F.arrays_zip(
        F.coalesce(F.col(types), F.array()).alias("source_type"),
        F.coalesce(F.col(scores), F.array()).alias("score"),
    )
    rows = models.select(*by, F.posexplode(pairs).alias("id", "a"))
    return rows.select(
        *by,
        "id",
        F.col("a.source_type").cast("int").alias("source_type"),
        F.col("a.score").cast("float").alias("score"),
    )


def typed_tokens_from_arrays(
    models: DataFrame,
    by: Sequence[str] = (),
    tokens: str = "tokens",
    types: str = "token_types",
    scores: str = "scores",
) -> DataFrame:
    """Rows (by.., id, token, source_type, score) of models that hold all three lists.

    Lists of one row are aligned in place, so this needs no join. Types and
    scores may be missing or shorter than the tokens; what is longer is dropped.
    """
    size = F.size(tokens)
    zipped = F.arrays_zip(
        F.col(tokens).alias("token"),
        F.slice(F.coalesce(F.col(types), F.array()), F.lit(1), size).alias("source_type"),
        F.slice(F.coalesce(F.col(scores), F.array()), F.lit(1), size).alias("score"),
    )
    rows = models.select(*by, F.posexplode(zipped).alias("id", "t"))
    return rows.select(
        *by,
        "id",
        named_empty(F.col("t.token"), F.col("id")).alias("token"),
        F.col("t.source_type").cast("int").alias("source_type"),
        F.col("t.score").cast("float").alias("score"),
    )


def with_attributes(tokens: DataFrame, attributes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attach types and scores to tokens; tokens without either keep nulls."""
    return tokens.join(attributes, [*by, "id"], "left")


def select_metadata(kv: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per model from (by.., key, value variant) rows.

    Known keys become typed columns and unknown keys are dropped before the
    shuffle. Rows have no order, so of a repeated key the greatest value counts.
    """
    known = {**SCALAR_KEYS, **ARRAY_KEYS}
    picked = kv.where(F.col("key").isin(list(known)))
    models = picked.groupBy(*by).agg(F.collect_list(F.struct("key", "value")).alias("entries"))

    def greatest(key: str, kind: str) -> Column:
        own = F.filter("entries", lambda e: e["key"] == key)
        return F.array_max(F.transform(own, lambda e: F.try_variant_get(e["value"], "$", kind)))

    columns = {name: greatest(key, kind) for key, (name, kind) in known.items()}
    columns["add_bos"] = F.coalesce(columns["add_bos"], F.lit(False))
    return models.select(*by, *[column.alias(name) for name, column in columns.items()])


def parse_tokenizer_json(files: DataFrame, by: Sequence[str] = (), body: str = "value") -> DataFrame:
    """Parse tokenizer.json texts to (by.., model_type, vocab, merges, added_tokens, pattern).

    ``pattern`` is the file's pre-tokenizer pattern, in the inline spelling; null
    if the file has no pre-tokenizer. One that splits otherwise, or by more than
    one pattern, sets ``error``. Merges may be written as "left right" strings or as [left, right] pairs;
    pairs are brought to the string form. Only byte-level BPE models are
    accepted, and only without the fields of ``UNBUILT``, which would change ids:
    the others stay as rows with ``error`` set and no tables.
    """
    text = F.col(body)
    patterns = F.array_compact(
        F.array(
            F.get_json_object(text, "$.pre_tokenizer.pattern.Regex"),
            *[F.get_json_object(text, f"$.pre_tokenizer.pretokenizers[{i}].pattern.Regex") for i in range(PLACES)],
        )
    )
    given = F.get_json_object(text, "$.pre_tokenizer").isNotNull()
    own = F.get_json_object(text, "$.pre_tokenizer.type") == "ByteLevel"
    own &= F.coalesce(F.get_json_object(text, "$.pre_tokenizer.use_regex"), F.lit("true")) == "true"
    pattern = F.coalesce(F.try_element_at(patterns, F.lit(1)), F.when(own, F.lit(BYTE_LEVEL_PATTERN)))
    unsplit = F.when(
        (F.size(patterns) > 1)
        | (given & pattern.isNull())
        | F.get_json_object(text, f"$.pre_tokenizer.pretokenizers[{PLACES}]").isNotNull(),
        F.lit("not supported: pre_tokenizer"),
    )
    parsed = files.select(
        *by,
        normalize_pattern(pattern).alias("pattern"),
        F.from_json(text, _TOKENIZER_JSON).alias("t"),
        F.get_json_object(text, "$.model.merges[0][0]").isNotNull().alias("pairs"),
        F.coalesce(unbuilt(text), unsplit).alias("refused"),
    )
    kind = F.col("t.model.type")
    error = F.coalesce(rejection(kind), F.col("refused"))
    accepted = error.isNull()
    merges = F.when(
        F.col("pairs"),
        F.transform("t.model.merges", lambda m: F.array_join(F.from_json(m, "array<string>"), " ")),
    ).otherwise(F.col("t.model.merges"))
    return parsed.select(
        *by,
        kind.alias("model_type"),
        F.when(accepted, F.col("t.model.vocab")).alias("vocab"),
        F.when(accepted, merges).alias("merges"),
        F.when(accepted, F.col("t.added_tokens")).alias("added_tokens"),
        "pattern",
        error.alias("error"),
    )


def unbuilt(text: Column) -> Column:
    """Which field of a tokenizer.json text asks for something that is not built; null when none does."""
    return F.coalesce(
        *[
            F.when(
                ~F.coalesce(F.get_json_object(text, f"$.{path}"), F.lit("")).isin("", "false", "[]", "null"),
                F.lit(f"not supported: {path}"),
            )
            for path in UNBUILT
        ]
    )


def rejection(model_type: Column) -> Column:
    """Why a model is not accepted; null when it is."""
    return F.when(
        F.coalesce(model_type != "BPE", F.lit(True)),
        F.concat(
            F.lit("not a byte-level BPE model: "), F.coalesce(model_type, F.lit("no type"))
        ),
    )


def tokens_from_json(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by.., id, token, source_type, score) of parsed tokenizer.json models.

    Added tokens get the source type of control tokens, whether or not the
    vocabulary map lists them as well. Each file is read in place, and its text once; only
    rows of a model that has several are shuffled.
    """
    plain = F.transform(
        F.map_entries("vocab"), lambda e: F.struct(e["value"].alias("id"), F.lit(False).alias("is_added"), e["key"].alias("token"))
    )
    added = F.transform(
        "added_tokens", lambda a: F.struct(a["id"].alias("id"), F.lit(True).alias("is_added"), a["content"].alias("token"))
    )
    none = F.array().cast("array<struct<id: int, is_added: boolean, token: string>>")
    listed = F.sort_array(F.concat(F.coalesce(plain, none), F.coalesce(added, none)))
    models = parsed.select(*by, listed.alias("listed"))
    # Of one id the last entry is an added token, if one has it.
    last = F.filter("listed", lambda e, i: ~F.coalesce(F.get("listed", i + 1)["id"].eqNullSafe(e["id"]) & (i + 1 < F.size("listed")), F.lit(False)))
    models = models.select(*by, last.alias("listed"))
    repeated = parsed.groupBy(*by).count().where("count > 1").drop("count")
    if repeated.isEmpty():
        rows = _listed(models, by)
    else:
        # Several rows of one model are put together, so that each of its ids comes once.
        same = F.lit(True)
        for name in by:
            same &= F.col(f"m.`{name}`").eqNullSafe(F.col(f"r.`{name}`"))
        if by:
            once = models.alias("m").join(repeated.alias("r"), same, "left_anti")
            several = models.alias("m").join(repeated.alias("r"), same, "left_semi")
        else:
            once, several = models.limit(0), models
        merged = _listed(several, by).groupBy(*by, "id").agg(F.max_by("token", "is_added").alias("token"), F.max("is_added").alias("is_added"))
        rows = _listed(once, by).unionByName(merged)
    return rows.select(
        *by,
        "id",
        named_empty(F.col("token"), F.col("id")).alias("token"),
        F.when(F.col("is_added"), 3).otherwise(1).alias("source_type"),
        F.lit(None).cast("float").alias("score"),
    )


def _listed(models: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows (by.., id, token, is_added) of the entries in ``listed``.

    An outer explode: for an inner one Spark tests the array below it as well, and so
    parses each text once more.
    """
    rows = models.select(*by, F.explode_outer("listed").alias("e")).where("e IS NOT NULL")
    return rows.select(*by, "e.id", "e.token", "e.is_added")


def read_tokenizer_json(spark: SparkSession, path: str) -> DataFrame:
    """tokenizer.json files, one model per file, named by ``model_path``."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("model_path"), "value"
    )
    return parse_tokenizer_json(files, ["model_path"])
