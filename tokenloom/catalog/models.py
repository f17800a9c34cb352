"""Queries with vocabularies of real size, many models, and long chunks."""

from __future__ import annotations

import dataclasses
import importlib.util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog import sql
from tokenloom.catalog.base import Entry, documents, joined, long
from tokenloom.fixtures import END_OF_TEXT, MERGES_64, USER, large_file, model_arrays, vocabulary_64, vocabulary_of_file
from tokenloom.functions.chunks import DEFAULT_PATTERN, cut_added
from tokenloom.operators.models import MODEL, models_from_metadata, tokenize_by_model
from tokenloom.operators.tokens import token_counts, tokenize
from tokenloom.sources.corpus import read_corpus

# -- one chunk per page -----------------------------------------------------

WHOLE = r"[\s\S]+"


def page_ids_of_whole_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as one chunk, most of them far too long for the string plans."""
    pages = read_corpus(spark, f"{folder}/pages.parquet", ["page_id"], text="html")
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None, pattern=WHOLE)
    tokens = tokenize(pages, vocab, ["page_id"])
    return tokens.select("page_id", joined(F.col("ids")).alias("ids"), long("n_tokens"))


PAGE_IDS_SQL = f"""WITH {sql.vocab()}, occ AS (SELECT DISTINCT html AS chunk FROM pages), {sql.encoded()}
    SELECT page_id, coalesce(ids, '') AS ids, coalesce(n, 0)::BIGINT AS n_tokens FROM pages LEFT JOIN enc ON chunk = html"""


# -- a tokenizer file with 50,000 merges ------------------------------------


def document_ids_of_file(spark: SparkSession, folder: str) -> DataFrame:
    tokens = tokenize(documents(spark, folder), vocabulary_of_file(spark, large_file()))
    return tokens.select("doc_id", joined(F.col("ids")).alias("ids"), long("n_tokens"), "ok")


def tokens_by_source_of_file(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder, ["source"]), vocabulary_of_file(spark, large_file()), ["source"], few_groups=True)


# Words of the file's vocabulary that stand as added tokens, spelled in the byte alphabet.
ADDED_WORDS = "\u0120[A-Za-z]{3,}"


def texts_without_added_words(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cut by every word of a large vocabulary, tens of thousands: what is left, a mark for each word cut out."""
    listed = vocabulary_of_file(spark, large_file()).tokens.where(F.col("token").rlike(f"^{ADDED_WORDS}$"))
    # A part of one vocabulary, as added tokens are.
    added = [" " + r["token"][1:] for r in listed.select("token").collect()]
    cut = documents(spark, folder).select("doc_id", cut_added(F.col("text"), added).alias("pieces"))
    mark = F.transform("pieces", lambda p: F.concat(p["part"], F.when(p["token"].isNotNull(), "\x01").otherwise("")))
    found = F.array_compact(F.col("pieces.token"))
    return cut.select(
        "doc_id",
        F.size(found).cast("bigint").alias("n_added"),
        F.sha2(F.array_join(found, ""), 256).alias("added_sha256"),
        F.sha2(F.array_join(mark, ""), 256).alias("rest_sha256"),
    )


def _cut_sql() -> str:
    # A word to cut out has one space, at its start, so the longest that begins each " letters" is cut out.
    return f"""WITH file AS MATERIALIZED (
      SELECT unnest(map_keys(model.vocab)) AS tok FROM read_json({sql.quoted(large_file())}, maximum_object_size=1000000000,
        columns={{model: 'STRUCT(vocab MAP(VARCHAR, BIGINT))'}})),
    added AS MATERIALIZED (SELECT ' ' || substr(tok, 2) AS word FROM file WHERE regexp_full_match(tok, '{ADDED_WORDS}')),
    cut AS (SELECT doc_id, regexp_extract_all(text, ' [A-Za-z]+') AS runs, string_split_regex(text, ' [A-Za-z]+') AS parts FROM documents),
    occ AS (SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS part, unnest(list_concat(runs, [''])) AS run FROM cut),
    beginnings AS (SELECT run, unnest(range(1, length(run) + 1)) AS n FROM (SELECT DISTINCT run FROM occ)),
    longest AS (SELECT run, max(n) AS n FROM beginnings JOIN added ON left(run, n) = word GROUP BY run)
    SELECT doc_id, count(n)::BIGINT AS n_added,
      sha256(string_agg(coalesce(left(run, n), ''), '' ORDER BY i)) AS added_sha256,
      sha256(string_agg(part || coalesce(chr(1) || substr(run, n + 1), run), '' ORDER BY i)) AS rest_sha256
    FROM occ LEFT JOIN longest USING (run) GROUP BY doc_id"""


# -- many models in one job -------------------------------------------------

# By language: how many of the merges its model has, its pre-tokenizer, and whether it begins with the BOS id.
MODELS = {"en": (64, "default", True), "de": (32, "default", False), "fr": (64, None, False), "es": (16, "words", True)}
WORDS = "[^ ]+| +"


def metadata_rows(spark: SparkSession, languages: DataFrame) -> DataFrame:
    """(model_name, key, value): a model for each language of a table."""
    models = []
    for name, (n_merges, pre, add_bos) in MODELS.items():
        arrays = model_arrays(spark, MERGES_64[:n_merges], (END_OF_TEXT, USER))
        pairs = {
            "tokenizer.ggml.model": F.lit('"gpt2"'),
            "tokenizer.ggml.tokens": F.to_json("tokens"),
            "tokenizer.ggml.merges": F.to_json("merges"),
            "tokenizer.ggml.token_type": F.to_json("token_types"),
            "tokenizer.ggml.bos_token_id": F.lit(str(END_OF_TEXT[1])),
            "tokenizer.ggml.add_bos_token": F.lit("true" if add_bos else "false"),
            "general.name": F.lit('"no part of a tokenizer"'),
        }
        if pre:
            pairs["tokenizer.ggml.pre"] = F.lit(f'"{pre}"')
        rows = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("json")) for k, v in pairs.items()))
        models.append(arrays.select(F.lit(name).alias(MODEL), F.inline(rows)))
    every = models[0]
    for more in models[1:]:
        every = every.union(more)
    return every.join(languages, MODEL, "left_semi").select(MODEL, "key", F.parse_json("json").alias("value"))


def metadata_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document between two control tokens, by the model that the metadata of its language describes."""
    texts = documents(spark, folder, ["lang"]).withColumnRenamed("lang", MODEL)
    models = models_from_metadata(metadata_rows(spark, texts.select(MODEL).distinct()), {"default": DEFAULT_PATTERN, "words": WORDS})
    marked = texts.withColumn("text", F.concat(F.lit(USER[0]), F.col("text"), F.lit(END_OF_TEXT[0])))
    tokens = tokenize_by_model(marked, models)
    return tokens.select("doc_id", MODEL, joined(F.col("ids")).alias("ids"), long("n_tokens"), "ok")


def _metadata_ids_sql() -> str:
    parts, results = [], []
    for name, (n_merges, pre, add_bos) in MODELS.items():
        pattern = sql.quoted(WORDS) if pre == "words" else sql.PATTERN
        parts.append(f"""{sql.vocab(n_merges, name + '_vocab')},
    {name}_occ AS (
      SELECT doc_id, unnest(range(len(c)))::BIGINT AS pos, unnest(c) AS chunk
      FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS c FROM documents WHERE lang = '{name}')),
    {sql.encoded(n_merges, name + '_occ', name + '_enc', name + '_vocab')}""")
        bos = f"{END_OF_TEXT[1]} " if add_bos else ""
        results.append(f"""SELECT doc_id, lang AS model_name, '{bos}{USER[1]} ' || coalesce(ids || ' ', '') || '{END_OF_TEXT[1]}' AS ids,
      coalesce(n, 0)::BIGINT + {2 + add_bos} AS n_tokens, true AS ok
      FROM documents LEFT JOIN (
        SELECT doc_id, string_agg(ids, ' ' ORDER BY pos) AS ids, sum(n) AS n
        FROM {name}_occ JOIN {name}_enc USING (chunk) GROUP BY doc_id) USING (doc_id)
      WHERE lang = '{name}'""")
    return "WITH " + ", ".join(parts) + " UNION ALL ".join(results)


ENTRIES: dict[str, Entry] = {
    "page_ids_of_whole_texts": Entry("JN4", page_ids_of_whole_texts, PAGE_IDS_SQL),
    "metadata_ids": Entry("SRC5, PRJ11, PRJ12", metadata_ids, _metadata_ids_sql()),
}
# The file comes with a package that may be absent.
if importlib.util.find_spec("public_tokenizers"):
    ENTRIES |= {
        "document_ids_of_file": Entry(
            "SRC2, JN4",
            document_ids_of_file,
            f"""WITH RECURSIVE {sql.occurrences('documents', 'doc_id')}, {sql.encoded_by_file(large_file())}
    SELECT d.doc_id, coalesce(string_agg(ids, ' ' ORDER BY pos), '') AS ids, coalesce(sum(n), 0)::BIGINT AS n_tokens, true AS ok
    FROM documents d LEFT JOIN occ USING (doc_id) LEFT JOIN enc USING (chunk) GROUP BY d.doc_id""",
        ),
        "texts_without_added_words": Entry("PRJ11", texts_without_added_words, _cut_sql()),
        "tokens_by_source_of_file": Entry(
            "SRC2, JN4, AG3",
            tokens_by_source_of_file,
            f"""WITH RECURSIVE {sql.occurrences('documents', 'source')}, {sql.encoded_by_file(large_file())}
    SELECT source, sum(n)::BIGINT AS n_tokens FROM occ JOIN enc USING (chunk) GROUP BY source""",
        ),
    }
