"""Queries over vocabulary tables.

The given tables hold no model files, so the vocabularies here are made from the
documents. Two kinds are used:

* one model per document: its words are the token list, its sentences the merge
  list, so positions, empty tokens and merge splitting all occur;
* one model for the corpus: every chunk occurrence is a token list entry, and
  each distinct chunk, cut after its first and before its last byte, gives merges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog import sql
from tokenloom.catalog.base import Entry, conversations, documents, long
from tokenloom.fixtures import vocabulary_64
from tokenloom.functions.alphabet import byte_alphabet, char_to_byte, token_hex
from tokenloom.functions.chunks import (
    INLINE_CONTRACTIONS,
    SPELLED_OUT_CONTRACTIONS,
    normalize_pattern,
)
from tokenloom.operators.dictionary import count_chunks, occurrences
from tokenloom.operators.vocab_tables import (
    byte_tokens,
    concat_mismatches,
    duplicate_merges,
    first_ids,
    ids_for_texts,
    merge_order,
    resolve_merges,
    token_table,
    two_sided,
    unresolved_merges,
    validate_merges,
    vocab_summary,
)
from tokenloom.plans.workspace import written
from tokenloom.sources.vocab import (
    attributes_from_arrays,
    merges_from_arrays,
    parse_tokenizer_json,
    select_metadata,
    tokens_from_arrays,
    tokens_from_json,
    typed_tokens_from_arrays,
    with_attributes,
)

_MODEL = ["doc_id"]

# -- one model per document -------------------------------------------------

_WORDS = "[. \\n]"
_SENTENCES = "[.\\n]"


def _models(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, tokens, merges, token_types, scores): types for all, scores for most words."""
    words = F.split("text", _WORDS, -1)
    types = F.transform(
        words, lambda w: F.when(F.char_length(w) == 1, 6).when(w.rlike("^[a-z]"), 1).otherwise(3)
    )
    scored = F.slice(words, F.lit(1), F.size(words) - 1)
    scores = F.transform(scored, lambda w: F.char_length(w).cast("float"))
    return documents(spark, folder).select(
        "doc_id",
        words.alias("tokens"),
        F.split("text", _SENTENCES, -1).alias("merges"),
        types.alias("token_types"),
        scores.alias("scores"),
    )


_TOKENS_SQL = f"""listed AS (
      SELECT doc_id, unnest(range(len(w)))::BIGINT AS id, unnest(w) AS raw, len(w) AS size
      FROM (SELECT doc_id, string_split_regex(text, '{_WORDS}') AS w FROM documents)),
    tokens AS (
      SELECT doc_id, id, size, raw, CASE WHEN raw = '' THEN '[EMPTY_' || id || ']' ELSE raw END AS token FROM listed)"""

_MERGES_SQL = f"""sentences AS (
      SELECT doc_id, unnest(range(len(m)))::BIGINT AS rank, unnest(m) AS m
      FROM (SELECT doc_id, string_split_regex(text, '{_SENTENCES}') AS m FROM documents)),
    cut AS (SELECT *, CASE WHEN substr(m, 2) LIKE '% %' THEN strpos(substr(m, 2), ' ') + 1 END AS space FROM sentences),
    merges AS (
      SELECT doc_id, rank, CASE WHEN space IS NULL THEN m ELSE substr(m, 1, space - 1) END AS "left",
        CASE WHEN space IS NULL THEN '' ELSE substr(m, space + 1) END AS "right" FROM cut)"""

_TYPED_SQL = f"""{_TOKENS_SQL},
    typed AS (
      SELECT doc_id, id, token,
        CASE WHEN length(raw) = 1 THEN 1 WHEN regexp_matches(raw, '^[a-z]') THEN 0 ELSE 2 END::BIGINT AS token_type,
        CASE WHEN id < size - 1 THEN length(raw) ELSE 0 END::DOUBLE AS score FROM tokens)"""


def listed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens_from_arrays(_models(spark, folder), _MODEL).select("doc_id", long("id"), "token")


def listed_merges(spark: SparkSession, folder: str) -> DataFrame:
    return merges_from_arrays(_models(spark, folder), _MODEL).select("doc_id", long("rank"), "left", "right")


def two_sided_merges(spark: SparkSession, folder: str) -> DataFrame:
    return two_sided(merges_from_arrays(_models(spark, folder), _MODEL)).select(
        "doc_id", long("rank"), "left", "right"
    )


def _token_tables(spark: SparkSession, folder: str) -> DataFrame:
    return token_table(typed_tokens_from_arrays(_models(spark, folder), _MODEL), _MODEL)


def typed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Types mapped, scores filled in, both aligned by position."""
    return _token_tables(spark, folder).select(
        "doc_id", long("id"), "token", long("token_type"), F.col("score").cast("double").alias("score")
    )


def joined_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """The same where tokens and attributes are separate tables."""
    models = _models(spark, folder)
    tokens = with_attributes(
        tokens_from_arrays(models, _MODEL), attributes_from_arrays(models, _MODEL), _MODEL
    )
    return token_table(tokens, _MODEL).select(
        "doc_id", long("id"), "token", long("token_type"), F.col("score").cast("double").alias("score")
    )


def vocabulary_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_summary(_token_tables(spark, folder), _MODEL)


VOCABULARY_SIZES_SQL = f"""WITH {_TYPED_SQL}
    SELECT doc_id, count(*)::BIGINT AS vocab_size, count_if(token_type = 0)::BIGINT AS normal_tokens,
      count_if(token_type = 1)::BIGINT AS byte_tokens, count_if(token_type = 2)::BIGINT AS special_tokens
    FROM typed GROUP BY doc_id"""


def merge_counts(spark: SparkSession, folder: str) -> DataFrame:
    merges = merges_from_arrays(_models(spark, folder), _MODEL)
    return merges.groupBy("doc_id").agg(F.count("*").alias("n_merges"), F.count_if(F.col("right") != "").alias("n_two_sided"))


def ranked_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Merges of every model in rank order, in one array."""
    merges = merges_from_arrays(_models(spark, folder), _MODEL)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "left", "right")))
    rows = merges.groupBy("doc_id").agg(ordered.alias("m"))
    return rows.select(
        "doc_id",
        F.array_join(F.transform("m", lambda m: F.concat(m["left"], F.lit("+"), m["right"])), "|").alias("merges"),
    )


_KEPT = """SELECT doc_id, source AS model, lang AS pre, n_chars AS bos_id, n_chars + 1 AS eos_id,
      CASE WHEN lang = 'en' THEN n_chars + 2 END AS pad_id, CASE WHEN lang <> 'de' THEN n_chars + 3 END AS unknown_id,
      lang = 'en' AS add_bos,
      len(string_split_regex(text, '[. \\n]'))::BIGINT AS n_tokens,
      len(string_split_regex(text, '[.\\n]'))::BIGINT AS n_merges,
      list_sum(list_transform(string_split_regex(text, '[. \\n]'), lambda w: length(w)))::BIGINT AS sum_types,
      CASE WHEN lang <> 'fr' THEN list_sum(list_transform(string_split_regex(text, '[. \\n]'), lambda w: length(w) / 2)) END::DOUBLE
        AS sum_scores
    FROM documents"""


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Key/value rows of every model, from which the known keys are picked; some models lack some keys."""
    texts = documents(spark, folder, ["source", "lang", "n_chars"])

    def pair(key: str, value) -> F.Column:
        return F.struct(F.lit(key).alias("key"), value.alias("json"))

    def as_json(value) -> F.Column:
        # to_json takes no bare scalars, so a value is written inside an array.
        return F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1)

    words = F.split("text", _WORDS, -1)
    sizes = F.transform(words, F.char_length)
    halves = F.transform(words, lambda w: F.char_length(w) / 2)
    pairs = F.array(
        pair("tokenizer.ggml.model", as_json(F.col("source"))),
        pair("tokenizer.ggml.pre", as_json(F.col("lang"))),
        pair("tokenizer.ggml.bos_token_id", as_json(F.col("n_chars"))),
        pair("tokenizer.ggml.eos_token_id", as_json(F.col("n_chars") + 1)),
        pair("tokenizer.ggml.add_bos_token", as_json(F.col("lang") == "en")),
        F.when(F.col("lang") == "en", pair("tokenizer.ggml.padding_token_id", as_json(F.col("n_chars") + 2))),
        F.when(F.col("lang") != "de", pair("tokenizer.ggml.unknown_token_id", as_json(F.col("n_chars") + 3))),
        pair("tokenizer.ggml.token_type", F.to_json(sizes)),
        F.when(F.col("lang") != "fr", pair("tokenizer.ggml.scores", F.to_json(halves))),
        pair("tokenizer.ggml.tokens", F.to_json(words)),
        pair("tokenizer.ggml.merges", F.to_json(F.split("text", _SENTENCES, -1))),
        pair("general.name", as_json(F.col("source"))),
    )
    kv = texts.select("doc_id", F.explode(F.array_compact(pairs)).alias("p")).select(
        "doc_id", "p.key", F.parse_json("p.json").alias("value")
    )
    picked = select_metadata(kv, _MODEL)
    return picked.select(
        "doc_id",
        "model",
        "pre",
        *[long(c) for c in ("bos_id", "eos_id", "pad_id", "unknown_id")],
        "add_bos",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size("merges").cast("bigint").alias("n_merges"),
        F.aggregate("token_types", F.lit(0).cast("bigint"), lambda s, t: s + t).alias("sum_types"),
        F.aggregate("scores", F.lit(0.0), lambda s, t: s + t).alias("sum_scores"),
    )


def _tokenizer_files(spark: SparkSession, folder: str) -> DataFrame:
    """A tokenizer.json text per document; German ones claim another model type."""
    texts = documents(spark, folder, ["lang"])
    words = F.array_distinct(F.split("text", _WORDS, -1))
    vocab = F.map_from_arrays(words, F.sequence(F.lit(0), F.size(words) - 1))
    model = F.struct(
        F.when(F.col("lang") == "de", "Unigram").otherwise("BPE").alias("type"),
        vocab.alias("vocab"),
        F.split("text", _SENTENCES, -1).alias("merges"),
    )
    added = F.array(
        F.struct(
            F.size(words).alias("id"), F.lit("<|endoftext|>").alias("content"), F.lit(True).alias("special")
        )
    )
    return texts.select(
        "doc_id", F.to_json(F.struct(model.alias("model"), added.alias("added_tokens"))).alias("value")
    )


def tokenizer_json_tokens(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_tokenizer_json(_tokenizer_files(spark, folder), _MODEL)
    return tokens_from_json(parsed, _MODEL).select("doc_id", long("id"), "token", long("source_type"))


_JSON_SQL = """words AS (
      SELECT doc_id, lang, w, len(string_split_regex(text, '[.\\n]')) AS n_merges
      FROM (SELECT *, string_split_regex(text, '[. \\n]') AS w FROM documents)),
    firsts AS (SELECT doc_id, lang, token, min(i) AS place
      FROM (SELECT doc_id, lang, unnest(w) AS token, unnest(range(len(w))) AS i FROM words) GROUP BY ALL),
    numbered AS (SELECT doc_id, lang, token, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS id FROM firsts)"""

TOKENIZER_JSON_TOKENS_SQL = f"""WITH {_JSON_SQL}
    SELECT doc_id, id::BIGINT AS id, CASE WHEN token = '' THEN '[EMPTY_' || id || ']' ELSE token END AS token,
      1::BIGINT AS source_type FROM numbered WHERE lang <> 'de'
    UNION ALL SELECT doc_id, max(id)::BIGINT + 1, '<|endoftext|>', 3 FROM numbered WHERE lang <> 'de' GROUP BY doc_id"""


def accepted_models(spark: SparkSession, folder: str) -> DataFrame:
    """Which models are byte-level BPE; the others stay, with the reason."""
    parsed = parse_tokenizer_json(_tokenizer_files(spark, folder), _MODEL)
    return parsed.select(
        "doc_id",
        "model_type",
        F.when(F.col("vocab").isNotNull(), F.size("vocab")).cast("bigint").alias("n_tokens"),
        F.when(F.col("merges").isNotNull(), F.size("merges")).cast("bigint").alias("n_merges"),
        "error",
    )


ACCEPTED_MODELS_SQL = f"""WITH {_JSON_SQL}
    SELECT doc_id, CASE WHEN lang = 'de' THEN 'Unigram' ELSE 'BPE' END AS model_type,
      CASE WHEN lang <> 'de' THEN len(list_distinct(w)) END::BIGINT AS n_tokens,
      CASE WHEN lang <> 'de' THEN n_merges END::BIGINT AS n_merges,
      CASE WHEN lang = 'de' THEN 'not a byte-level BPE model: Unigram' END AS error FROM words"""


def pattern_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Per document a pattern in the spelled-out form, brought to the inline form."""
    pattern = F.concat(F.lit(SPELLED_OUT_CONTRACTIONS + "|"), F.col("source"), F.lit("|"), F.col("text"))
    return documents(spark, folder, ["source"]).select("doc_id", normalize_pattern(pattern).alias("pattern"))


PATTERN_SPELLINGS_SQL = f"""SELECT doc_id,
      replace({sql.quoted(SPELLED_OUT_CONTRACTIONS + '|')} || source || '|' || text,
        {sql.quoted(SPELLED_OUT_CONTRACTIONS)}, {sql.quoted(INLINE_CONTRACTIONS)}) AS pattern FROM documents"""

# -- spelling in the byte alphabet ------------------------------------------


def token_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct words read as tokens in the byte alphabet."""
    words = documents(spark, folder).select(F.explode(F.split("text", " ", -1)).alias("token")).distinct()
    return words.select("token", token_hex(F.col("token")).alias("tok_hex"))


# The alphabet as SQL, from the byte ranges.
_BYTE_SQL = """CASE WHEN {c} BETWEEN 33 AND 126 OR {c} BETWEEN 161 AND 172 OR {c} BETWEEN 174 AND 255 THEN {c}
      WHEN {c} BETWEEN 256 AND 288 THEN {c} - 256 WHEN {c} BETWEEN 289 AND 322 THEN {c} - 162 WHEN {c} = 323 THEN 173 END"""

TOKEN_BYTES_SQL = f"""WITH words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents),
    spelled AS (SELECT token, list_transform(string_split(token, ''), lambda c: {_BYTE_SQL.format(c='unicode(c)')}) AS b FROM words)
    SELECT token, CASE WHEN token <> '' AND len(list_filter(b, lambda x: x IS NULL)) = 0
      THEN array_to_string(list_transform(b, lambda x: printf('%02X', x)), '') ELSE hex(token) END AS tok_hex FROM spelled"""


def character_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Characters of the documents and conversations, and the byte each stands for."""
    texts = documents(spark, folder).select("text").unionByName(conversations(spark, folder).select("text"))
    chars = texts.select(F.explode(F.split("text", "")).alias("char"))
    counts = chars.groupBy("char").agg(F.count("*").alias("n"))
    table = byte_alphabet(spark)
    listed = counts.join(F.broadcast(table), F.ascii("char") == F.col("code_point"), "left")
    return listed.select(
        "char", "n", long("byte"), char_to_byte(F.col("char")).cast("bigint").alias("computed")
    )


CHARACTER_BYTES_SQL = f"""WITH chars AS (
      SELECT unnest(string_split(text, '')) AS char FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)),
    counts AS (SELECT char, count(*)::BIGINT AS n FROM chars GROUP BY char)
    SELECT char, n, ({_BYTE_SQL.format(c='unicode(char)')})::BIGINT AS byte,
      ({_BYTE_SQL.format(c='unicode(char)')})::BIGINT AS computed FROM counts"""

# -- one model for the corpus -----------------------------------------------


def _corpus_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(id, tok_hex): every chunk occurrence as an entry, numbered by its place in the corpus."""
    rows = occurrences(documents(spark, folder), ["doc_id"], vocabulary_64(spark))
    place = F.col("doc_id") * sql.POSITIONS_PER_DOCUMENT + F.col("pos")
    return rows.select(place.alias("id"), F.hex(F.encode("chunk", "UTF-8")).alias("tok_hex"))


_IDS_SQL = f"""{sql.occurrences('documents', 'doc_id')},
    ids AS (SELECT hex(chunk) AS tok_hex, min(doc_id * {sql.POSITIONS_PER_DOCUMENT} + pos)::BIGINT AS id FROM occ GROUP BY chunk)"""


def _ids_with_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """First ids of the corpus tokens, after the 256 single bytes; stored, as three joins read them."""
    single = spark.range(256).select("id", F.lpad(F.hex("id"), 2, "0").alias("tok_hex"))
    listed = _corpus_tokens(spark, folder).withColumn("id", F.col("id") + 256)
    return written(first_ids(single.unionByName(listed)), "ids")


_IDS_WITH_BYTES_SQL = f"""{sql.occurrences('documents', 'doc_id')},
    ids AS (SELECT tok_hex, min(id)::BIGINT AS id FROM (
      SELECT printf('%02X', i) AS tok_hex, i AS id FROM range(256) b(i)
      UNION ALL SELECT hex(chunk), 256 + doc_id * {sql.POSITIONS_PER_DOCUMENT} + pos FROM occ) GROUP BY tok_hex)"""


def _corpus_merges(spark: SparkSession, folder: str, *tables: DataFrame) -> DataFrame:
    """(rank, left, right): two cuts of every distinct chunk, ranked by how often the chunk occurs."""
    vocab = vocabulary_64(spark)
    cuts = []
    for number, table in enumerate(tables):
        chunks = count_chunks(table, vocab)
        hexed = chunks.select("n", F.hex(F.encode("chunk", "UTF-8")).alias("h"))
        last = (F.length("h") / 2).cast("int") - 1
        cut = hexed.select("n", "h", F.explode(F.array_distinct(F.array(F.lit(1), last))).alias("size"))
        cuts.append(
            cut.select(
                (F.col("n") * 2 + number).alias("rank"),
                F.substring("h", F.lit(1), F.col("size") * 2).alias("left"),
                F.substring("h", F.col("size") * 2 + 1, F.length("h")).alias("right"),
            )
        )
    merges = cuts[0]
    for more in cuts[1:]:
        merges = merges.unionByName(more)
    return merges


def _merges_sql(*tables: str) -> str:
    parts = []
    for number, table in enumerate(tables):
        parts.append(
            f"""SELECT n * 2 + {number} AS rank, substr(h, 1, 2 * size) AS "left", substr(h, 2 * size + 1) AS "right"
            FROM (SELECT n, h, unnest(list_distinct([1, length(h) // 2 - 1])) AS size FROM (
              SELECT count(*) AS n, hex(chunk) AS h FROM (
                SELECT unnest(regexp_extract_all(text, {sql.PATTERN})) AS chunk FROM {table}) GROUP BY chunk))"""
        )
    return "cuts AS (" + " UNION ALL ".join(parts) + ")"


_RESOLVED_SQL = """resolved AS (
      SELECT rank, l.id AS left_id, r.id AS right_id, m.id AS merged_id FROM cuts
      JOIN ids l ON l.tok_hex = "left" JOIN ids r ON r.tok_hex = "right"
      JOIN ids m ON m.tok_hex = "left" || "right" WHERE "left" <> '' AND "right" <> '')"""

_REASONS_SQL = """reasons AS (
      SELECT rank, "left", "right", CASE WHEN "left" = '' OR "right" = '' THEN 'empty side'
        WHEN l.id IS NULL THEN 'left' WHEN r.id IS NULL THEN 'right' WHEN m.id IS NULL THEN 'merged' END AS reason
      FROM cuts LEFT JOIN ids l ON l.tok_hex = "left" LEFT JOIN ids r ON r.tok_hex = "right"
      LEFT JOIN ids m ON m.tok_hex = "left" || "right")"""

_ORDER_SQL = """made AS (SELECT merged_id, max(rank) AS made_by FROM resolved GROUP BY merged_id),
    ordered AS (
      SELECT resolved.*, NOT (coalesce(a.made_by, -1) >= rank OR coalesce(b.made_by, -1) >= rank) AS in_order
      FROM resolved LEFT JOIN made a ON a.merged_id = left_id LEFT JOIN made b ON b.merged_id = right_id)"""


def first_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return first_ids(_corpus_tokens(spark, folder))


def one_byte_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return byte_tokens(_corpus_tokens(spark, folder)).select(long("byte"), "id")


ONE_BYTE_SQL = f"""WITH {_IDS_SQL}
    SELECT ('0x' || tok_hex)::BIGINT AS byte, id FROM ids WHERE length(tok_hex) = 2"""


def conversation_chunk_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of the conversations looked up among those of the documents."""
    chunks = count_chunks(conversations(spark, folder), vocabulary_64(spark))
    rows = chunks.select(F.hex(F.encode("chunk", "UTF-8")).alias("tok_hex"), "n")
    return ids_for_texts(rows, first_ids(_corpus_tokens(spark, folder)))


CONVERSATION_CHUNK_IDS_SQL = f"""WITH {_IDS_SQL}, {sql.occurrences('conversations', 'conv_id, turn', name='talk')}
    SELECT hex(chunk) AS tok_hex, count(*)::BIGINT AS n, any_value(id) AS id
    FROM talk LEFT JOIN ids ON tok_hex = hex(chunk) GROUP BY chunk"""


def resolved_merges(spark: SparkSession, folder: str) -> DataFrame:
    ids = _ids_with_bytes(spark, folder)
    return resolve_merges(_corpus_merges(spark, folder, documents(spark, folder)), ids)


def dropped_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Cuts of conversation chunks that the document vocabulary cannot resolve."""
    ids = _ids_with_bytes(spark, folder)
    return unresolved_merges(_corpus_merges(spark, folder, conversations(spark, folder)), ids)


def ordered_merges(spark: SparkSession, folder: str) -> DataFrame:
    ids = _ids_with_bytes(spark, folder)
    return merge_order(resolve_merges(_corpus_merges(spark, folder, documents(spark, folder)), ids))


def repeated_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that documents and conversations both list."""
    ids = _ids_with_bytes(spark, folder)
    merges = _corpus_merges(spark, folder, documents(spark, folder), conversations(spark, folder))
    return duplicate_merges(resolve_merges(merges, ids))


def mismatched_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Merges with their sides swapped, whose bytes no longer give the merged token."""
    ids = _ids_with_bytes(spark, folder)
    merges = resolve_merges(_corpus_merges(spark, folder, documents(spark, folder)), ids)
    swapped = merges.select("rank", F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "merged_id")
    return concat_mismatches(swapped, ids)


def merge_problems(spark: SparkSession, folder: str) -> DataFrame:
    """All problems of the merges of documents and conversations, counted."""
    ids = _ids_with_bytes(spark, folder)
    merges = _corpus_merges(spark, folder, documents(spark, folder), conversations(spark, folder))
    problems = validate_merges(merges, ids)
    return problems.groupBy("problem").agg(F.count("*").alias("n"), F.min("rank").alias("lowest_rank"))


MERGE_PROBLEMS_SQL = f"""WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('documents', 'conversations')},
    {_RESOLVED_SQL}, {_REASONS_SQL}, {_ORDER_SQL},
    problems AS (
      SELECT 'unresolved: ' || reason AS problem, rank FROM reasons WHERE reason IS NOT NULL
      UNION ALL SELECT 'duplicate pair', min(rank) FROM resolved GROUP BY left_id, right_id HAVING count(*) > 1
      UNION ALL SELECT 'out of order', rank FROM ordered WHERE NOT in_order)
    SELECT problem, count(*)::BIGINT AS n, min(rank)::BIGINT AS lowest_rank FROM problems GROUP BY problem"""


ENTRIES: dict[str, Entry] = {
    "listed_tokens": Entry("SRC2, PRJ1", listed_tokens, f"WITH {_TOKENS_SQL} SELECT doc_id, id, token FROM tokens"),
    "listed_merges": Entry("SRC3, PRJ2, WN2", listed_merges, f'WITH {_MERGES_SQL} SELECT doc_id, rank, "left", "right" FROM merges'),
    "two_sided_merges": Entry(
        "PRJ3", two_sided_merges, f"""WITH {_MERGES_SQL} SELECT doc_id, rank, "left", "right" FROM merges WHERE "left" <> '' AND "right" <> ''"""
    ),
    "typed_tokens": Entry("SRC4, PRJ4, PRJ5", typed_tokens, f"WITH {_TYPED_SQL} SELECT * FROM typed"),
    "joined_attributes": Entry("SRC4, PRJ4, PRJ5", joined_attributes, f"WITH {_TYPED_SQL} SELECT * FROM typed"),
    "vocabulary_sizes": Entry("AG2", vocabulary_sizes, VOCABULARY_SIZES_SQL),
    "merge_counts": Entry(
        "AG2",
        merge_counts,
        f"""WITH {_MERGES_SQL} SELECT doc_id, count(*)::BIGINT AS n_merges, count_if("right" <> '')::BIGINT AS n_two_sided
        FROM merges GROUP BY doc_id""",
    ),
    "ranked_merges": Entry(
        "SO1",
        ranked_merges,
        f"""WITH {_MERGES_SQL} SELECT doc_id, string_agg("left" || '+' || "right", '|' ORDER BY rank) AS merges
        FROM merges GROUP BY doc_id""",
    ),
    "metadata": Entry("SRC5", metadata, _KEPT),
    "tokenizer_json_tokens": Entry("SRC2", tokenizer_json_tokens, TOKENIZER_JSON_TOKENS_SQL),
    "accepted_models": Entry("PRJ18", accepted_models, ACCEPTED_MODELS_SQL),
    "pattern_spellings": Entry("PRJ8", pattern_spellings, PATTERN_SPELLINGS_SQL),
    "token_bytes": Entry("PRJ6", token_bytes, TOKEN_BYTES_SQL),
    "character_bytes": Entry("PRJ6", character_bytes, CHARACTER_BYTES_SQL),
    "one_byte_tokens": Entry("PRJ7", one_byte_tokens, ONE_BYTE_SQL),
    "first_token_ids": Entry("AG1", first_token_ids, f"WITH {_IDS_SQL} SELECT tok_hex, id FROM ids"),
    "conversation_chunk_ids": Entry("JN6", conversation_chunk_ids, CONVERSATION_CHUNK_IDS_SQL),
    "resolved_merges": Entry("JN1", resolved_merges, f"WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('documents')}, {_RESOLVED_SQL} SELECT * FROM resolved"),
    "dropped_merges": Entry(
        "JN2", dropped_merges, f"WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('conversations')}, {_REASONS_SQL} SELECT * FROM reasons WHERE reason IS NOT NULL"
    ),
    "ordered_merges": Entry(
        "AG9", ordered_merges, f"WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('documents')}, {_RESOLVED_SQL}, {_ORDER_SQL} SELECT * FROM ordered"
    ),
    "repeated_merges": Entry(
        "AG9",
        repeated_merges,
        f"""WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('documents', 'conversations')}, {_RESOLVED_SQL}
        SELECT left_id, right_id, count(*)::BIGINT AS listed, min(rank)::BIGINT AS rank FROM resolved
        GROUP BY left_id, right_id HAVING count(*) > 1""",
    ),
    "mismatched_merges": Entry(
        "AG9",
        mismatched_merges,
        f"""WITH {_IDS_WITH_BYTES_SQL}, {_merges_sql('documents')}, {_RESOLVED_SQL}
        SELECT rank, right_id AS left_id, left_id AS right_id, merged_id FROM resolved
        JOIN ids l ON l.id = left_id JOIN ids r ON r.id = right_id WHERE r.tok_hex || l.tok_hex <> l.tok_hex || r.tok_hex""",
    ),
    "merge_problems": Entry("AG9", merge_problems, MERGE_PROBLEMS_SQL),
}
