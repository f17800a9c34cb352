"""Secret scanning through an inverted index of trigrams, with DataFrame functions only.

From each rule's expression comes a Boolean query over trigrams (``trigrams``). The
index has a posting (trigram, document) for every trigram that a query names; its
postings are intersected clause by clause, which gives the candidate documents of
each rule, and only those are searched by the rule's expression. A rule without
mandatory trigrams is searched for in every document.

Texts are not shuffled while the candidates are few enough to broadcast, which is
checked by counting them; beyond that, texts meet their candidates by a shuffle join
with the same result. A posting list is never gathered: clauses are counted per
document, in each task first.

Spans are code points from the start of a text, end exclusive, found left to right
without overlap per kind.

Nulls and odd input: a null or empty text has no spans. Documents of one id share
their candidates, and each is searched for itself, so repeated rows and null ids give
what their own text holds. An empty table gives an empty one. Other columns play no
part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.arrow import quoted
from tokenloom.llm.trigrams import trigram_query
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False
    # An expression that finds the same matches that count, faster.
    only_long: str | None = None
    # Its matches that count are those in which this group of it takes part.
    proof: int | None = None

    @property
    def expression(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern

    @property
    def search(self) -> str:
        return self.only_long or self.expression


# The three base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # A run of 16 or more is found at its start, so asking for 16 changes no match that counts.
    Rule("hex", r"[0-9a-f]+", 16, only_long=r"[0-9a-f]{16,}"),
)
# Published formats of well-known credentials.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"sk_live_[A-Za-z0-9]+", 24),
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # Whether a match begins in a run of token characters depends on the run's end alone, so a run
    # that does not lead to one is taken whole, and none is read again from each place in it.
    Rule(
        "jwt",
        r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
        only_long=r"eyJ[A-Za-z0-9_-]++(\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?",
        proof=1,
    ),
    Rule("bearer", r"Bearer\x20+([A-Za-z0-9._~+/=-]+)", 20, 1),
)
RULES = BASE + EXTRA

CHUNK = 256


def running_sums(numbers: Column) -> Column:
    """Sums of the first 1, 2, 3, ... elements. Works in chunks, so long arrays are not copied for each element."""

    def sums(array: Column) -> Column:
        """0, then the running sums, each step copying what is there."""
        start = F.array(F.lit(0).cast("int"))
        return F.aggregate(array, start, lambda done, x: F.concat(done, F.array((F.element_at(done, -1) + x).cast("int"))))

    places = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / CHUNK).cast("int"))
    inner = F.transform(places, lambda c: sums(F.slice(numbers, c * CHUNK + 1, F.lit(CHUNK))))

    def shifted(inner: Column) -> Column:
        bases = sums(F.transform(inner, lambda one: F.element_at(one, -1)))
        pairs = F.arrays_zip(inner.alias("one"), bases.alias("base"))
        moved = F.transform(
            F.slice(pairs, F.lit(1), F.size(inner)),
            lambda p: F.transform(F.slice(p["one"], F.lit(2), F.size(p["one"]) - 1), lambda x: x + p["base"]),
        )
        return F.flatten(moved)

    # A one-element array whose element is computed once, so that it can be named twice.
    whole = F.transform(F.array(inner), shifted)
    return F.when(F.size(numbers) > 0, F.element_at(whole, 1)).otherwise(F.array().cast("array<int>"))


def _matches(rule: Rule, text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rule.search), F.lit(0))


def _spans(rule: Rule, order: int, text: Column, matches: Column) -> Column:
    """Spans of the matches (an array column) that are long enough."""
    pieces = F.slice(F.split(text, rule.search, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(pieces, matches, lambda p, m: F.length(p) + F.length(m))
    found = F.zip_with(
        running_sums(steps),
        matches,
        lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"), m.alias("match")
        ),
    )
    group, expression = (rule.proof, rule.search) if rule.proof else (rule.group, rule.expression)
    size = (lambda s: F.length(s["match"])) if not group else (
        lambda s: F.length(F.regexp_extract(s["match"], expression, group))
    )
    long_enough = F.filter(found, lambda s: size(s) >= rule.least)
    plain = F.transform(long_enough, lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"]))
    return F.when(F.size(matches) > 0, plain).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start: int, order: int, end: int, kind: string>>"


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """trigram, id: which of the trigrams occur in which documents (``docs``: id, text), letter case aside."""
    lower = docs.select("id", F.lower("text").alias("lower"))
    found = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("lower"), t))
    return lower.select("id", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """id, kinds: the rules whose trigram query a document fulfils."""
    clauses = [(kind, n, t, len(c)) for kind, q in queries.items() for n, c in enumerate(q) for t in sorted(c)]
    rows = [
        F.struct(F.lit(k).alias("kind"), F.lit(n).alias("clause"), F.lit(t).alias("trigram"), F.lit(s).alias("size"))
        for k, n, t, s in clauses
    ]
    table = docs.sparkSession.range(1).select(F.inline(F.array(*rows)))
    listed = postings(docs, sorted({t for _, _, t, _ in clauses})).distinct()
    # One row per trigram of the rules: its size does not depend on the documents.
    joined = listed.join(F.broadcast(table), "trigram")
    full = joined.groupBy("id", "kind", "clause", "size").count().where("count = size")
    return full.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ``spans`` (start, order, end, kind; in order) of every row."""
    named = docs.select(quoted(key).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    if indexed:
        # A null id is looked up too, by null-safe equality.
        found = written(candidates(named, indexed), "candidates")
        count = found.count()
        found = found.select(F.col("id").alias("found_id"), "kinds")
        joined = named.join(hinted(found, count, 32 * count), F.col("id").eqNullSafe(F.col("found_id")), "left")
    else:
        joined = named.withColumn("kinds", F.lit(None).cast("array<string>"))
    nothing = F.array().cast("array<string>")
    matched = joined.select(
        "id",
        "text",
        *(
            (
                _matches(r, F.col("text"))
                if r.kind not in indexed
                else F.when(F.array_contains("kinds", r.kind), _matches(r, F.col("text"))).otherwise(nothing)
            ).alias(f"matches_{n}")
            for n, r in enumerate(rules)
        ),
    )
    spans = [_spans(r, n, F.col("text"), F.col(f"matches_{n}")) for n, r in enumerate(rules)]
    return matched.select("id", F.array_sort(F.flatten(F.array(*spans))).alias("spans"))


def spelt(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def secrets_in_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: counts and a digest of the base kinds, and all spans, of every document."""
    found = scan(spark.read.parquet(f"{folder}/documents.parquet"))
    counts = [F.size(F.filter("spans", _is_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(F.encode(spelt(base), "utf-8"), 256).alias("base_sha256"), spelt(F.col("spans")).alias("spans")
    )


def _sql_matches(rule: Rule, order: int) -> str:
    pattern = rule.expression.replace("'", "''")
    return f"""
  SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind,
         unnest(regexp_extract_all(text, '{pattern}', 0)) AS m,
         unnest(string_split_regex(text, '{pattern}')) AS p,
         generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS n
  FROM docs WHERE regexp_matches(text, '{pattern}')"""


def _sql_size(rule: Rule, order: int) -> str:
    pattern = rule.expression.replace("'", "''")
    return f"WHEN {order} THEN length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}"


SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matched AS ({" UNION ALL ".join(_sql_matches(r, n) for n, r in enumerate(RULES))}),
placed AS (
  SELECT *, sum(length(p) + length(coalesce(m, ''))) OVER (PARTITION BY doc_id, ord ORDER BY n) AS stop
  FROM matched),
kept AS (
  SELECT doc_id, ord, kind, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
  FROM placed
  WHERE m IS NOT NULL AND CASE ord {" ".join(_sql_size(r, n) for n, r in enumerate(RULES))} END)
SELECT d.doc_id,
       {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord)
                       FILTER (WHERE ord < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord), '') AS spans
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
GROUP BY d.doc_id
"""
