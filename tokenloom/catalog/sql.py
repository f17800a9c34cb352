"""The same work as plain SQL, for checking results with another engine.

The SQL encodes with nested literal replaces over bracketed hex, which shares
neither the state coding nor the plan of the Spark operators.
"""

from __future__ import annotations

from tokenloom.fixtures import MERGES_64
from tokenloom.functions.chunks import DEFAULT_PATTERN


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PATTERN = quoted(DEFAULT_PATTERN)

# Positions of a chunk in the corpus, as one number.
POSITIONS_PER_DOCUMENT = 16_777_216


def occurrences(table: str, key: str, text: str = "text", name: str = "occ") -> str:
    """CTE (key.., pos, chunk)."""
    return f"""{name} AS (
      SELECT {key}, unnest(range(len(c)))::BIGINT AS pos, unnest(c) AS chunk
      FROM (SELECT {key}, regexp_extract_all({text}, {PATTERN}) AS c FROM {table}))"""


def vocab(n_merges: int = 64, name: str = "vocab") -> str:
    """CTE (id, tok) of the small vocabulary, tok as hex."""
    merged = ", ".join(f"({256 + r}, '{m.replace('+', '')}')" for r, m in enumerate(MERGES_64[:n_merges]))
    return f"""{name} AS (
      SELECT i::INT AS id, printf('%02X', i) AS tok FROM range(256) t(i)
      UNION ALL SELECT * FROM (VALUES {merged}) v(id, tok))"""


def merges(n_merges: int = 64, name: str = "merges") -> str:
    """CTE (rank, l, r) of the small vocabulary, sides as hex."""
    rows = ", ".join("({}, '{}', '{}')".format(r, *m.split("+")) for r, m in enumerate(MERGES_64[:n_merges]))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) v(rank, l, r))"


def state(chunk: str, n_merges: int = 64) -> str:
    """Bracketed hex of an encoded chunk, one pair of brackets per token."""
    sql = f"regexp_replace(hex({chunk}), '(..)', '[\\1]', 'g')"
    for merge in MERGES_64[:n_merges]:
        left, right = merge.split("+")
        sql = f"replace({sql}, '[{left}][{right}]', '[{left}{right}]')"
    return sql


def encoded(n_merges: int = 64, source: str = "occ", name: str = "enc", vocab_name: str = "vocab") -> str:
    """CTEs ending in (chunk, ids, n): ids of each distinct chunk as text."""
    return f"""{name}_state AS (
      SELECT chunk, {state('chunk', n_merges)} AS st FROM (SELECT DISTINCT chunk FROM {source})),
    {name}_parts AS (
      SELECT chunk, unnest(range(len(p))) AS i, unnest(p) AS tok
      FROM (SELECT chunk, regexp_extract_all(st, '[0-9A-F]+') AS p FROM {name}_state)),
    {name} AS (
      SELECT chunk, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids, count(*)::BIGINT AS n
      FROM {name}_parts JOIN {vocab_name} USING (tok) GROUP BY chunk)"""


def counted(n_merges: int = 64, source: str = "occ", name: str = "enc") -> str:
    """CTE (chunk, n): token count of each distinct chunk."""
    st = state("chunk", n_merges)
    return f"""{name} AS (
      SELECT chunk, (length(st) - length(replace(st, '[', '')))::BIGINT AS n
      FROM (SELECT chunk, {st} AS st FROM (SELECT DISTINCT chunk FROM {source})))"""


def rows_of_ids(table: str, key: str, text: str = "text", n_merges: int = 64, name: str = "tok") -> str:
    """CTEs ending in (key.., ids, n_tokens) for every row of a table."""
    on = " AND ".join(f"b.{k.strip()} = s.{k.strip()}" for k in key.split(","))
    keys = ", ".join(f"b.{k.strip()}" for k in key.split(","))
    v, o, e = f"{name}_vocab", f"{name}_occ", f"{name}_enc"
    return f"""{vocab(n_merges, v)}, {occurrences(table, key, text, o)},
    {encoded(n_merges, o, e, v)},
    {name} AS (
      SELECT {keys}, coalesce(s.ids, '') AS ids, coalesce(s.n, 0)::BIGINT AS n_tokens
      FROM {table} b LEFT JOIN (
        SELECT {key}, string_agg(ids, ' ' ORDER BY pos) AS ids, sum(n)::BIGINT AS n
        FROM {o} JOIN {e} USING (chunk) GROUP BY {key}) s ON {on})"""


def encoded_by_file(path: str, source: str = "occ", name: str = "enc") -> str:
    """CTEs (recursive) ending in (chunk, ids, n): each distinct chunk encoded by the merges of a tokenizer.json file.

    A chunk is its tokens, spelled in the byte alphabet, each between two control
    characters; every step replaces the lowest-ranked pair of neighbours in all chunks.
    """
    mark = "chr(1)"
    return f"""{name}_file AS MATERIALIZED (
      SELECT model FROM read_json({quoted(path)}, maximum_object_size=1000000000,
        columns={{model: 'STRUCT(vocab MAP(VARCHAR, BIGINT), merges VARCHAR[][])'}})),
    {name}_ids AS MATERIALIZED (
      SELECT unnest(map_keys(model.vocab)) AS tok, unnest(map_values(model.vocab)) AS id FROM {name}_file),
    {name}_merges AS MATERIALIZED (
      SELECT rank, m[1] AS l, m[2] AS r
      FROM (SELECT unnest(range(len(model.merges))) AS rank, unnest(model.merges) AS m FROM {name}_file)),
    {name}_spelling AS MATERIALIZED (
      SELECT map_from_entries(list({{k: printf('%02X', b), v: chr(c::INT)}})) AS spelled
      FROM (SELECT b, CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 THEN b
                           WHEN b <= 32 THEN 256 + b WHEN b <= 160 THEN 162 + b ELSE 323 END AS c
            FROM (SELECT unnest(range(256)) AS b))),
    {name}_steps AS (
      SELECT chunk, {mark} || array_to_string(list_transform(regexp_extract_all(hex(encode(chunk)), '..'), lambda h: spelled[h]), {mark} || {mark}) || {mark} AS st,
        false AS done
      FROM (SELECT DISTINCT chunk FROM {source} WHERE chunk IS NOT NULL), {name}_spelling
      UNION ALL
      SELECT chunk, CASE WHEN best IS NULL THEN st ELSE
          replace(st, {mark} || best.l || {mark} || {mark} || best.r || {mark}, {mark} || best.l || best.r || {mark}) END, best IS NULL
      FROM (
        SELECT chunk, st, arg_min({{l: m.l, r: m.r}}, m.rank) AS best
        FROM (SELECT chunk, st, unnest(p[:-2]) AS l, unnest(p[2:]) AS r
              FROM (SELECT chunk, st, string_split(st[2:-2], {mark} || {mark}) AS p FROM {name}_steps WHERE NOT done)) x
        LEFT JOIN {name}_merges m ON x.l = m.l AND x.r = m.r
        GROUP BY chunk, st)),
    {name}_last AS MATERIALIZED (
      SELECT chunk, arg_min(st, length(st)) AS st FROM {name}_steps GROUP BY chunk),
    {name} AS MATERIALIZED (
      SELECT chunk, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids, count(*)::BIGINT AS n
      FROM (SELECT chunk, unnest(range(len(p))) AS i, unnest(p) AS tok
            FROM (SELECT chunk, string_split(st[2:-2], {mark} || {mark}) AS p FROM {name}_last))
      JOIN {name}_ids USING (tok) GROUP BY chunk)"""
