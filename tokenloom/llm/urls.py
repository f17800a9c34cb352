"""URL filtering by given rules and by rules mined from labelled pages.

FP-growth mines token combinations of the blocked URLs, which are then counted over all
labelled ones. A combination becomes a rule if enough blocked URLs have it (support, a
number and not a share, so more labels lose no rule), if the lower end of the interval
of its confidence (Wilson, 95 %) is high enough, and if no part of it is at least as
confident. Every blocked URL is mined with all its tokens. Tokens that always go together
are one item, and an item that takes no unblocked URL away from a combination is not added
to it: the result has no more misses than without it, so it is no surer. URLs with more
than ``MOST_ITEMS`` items left are divided into the conditional bases of FP-growth, one for
each combination they begin with, until what is left is short; a Spark job does that for
all combinations of one length, and FP-growth ends it. Work grows with the number of
combinations of which each item takes away an unblocked URL, which for many loosely mixed
items is exponential. Rules are matched by an inverted index: each is listed under its
rarest token, a URL looks up its tokens, and what it finds is verified in full. Each
distinct URL is matched once.

Given rules (host, path, verdict) fit a host and its subdomains where the path begins
with the rule's; the longest one decides, and only a URL without one is judged by the
mined rules: block if any matches, else allow.

Nulls and odd input: a null URL, or one without ``://``, has an empty host and path and
no tokens, and is allowed. Pages without a label play no part in mining; a page with
several labels is to be blocked if one of them says so. Without labels, or without a
rule that is good enough, nothing is blocked beyond the given rules. Repeated rows
give repeated results; an empty table gives an empty one. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.arrow import quoted
from tokenloom.llm.lines import ascii_lower
from tokenloom.llm.lookup import find
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written

MIN_COUNT = 10
MIN_CONFIDENCE = 0.5
MOST_ITEMS = 8  # FP-growth takes a base whose URLs have at most so many items; longer ones are divided first
RUN_ITEMS = 500_000  # the driver holds the items of one run of FP-growth; more bases are more runs
RUN_BASKETS = 100_000  # of one of FP-growth's partitions


@dataclass(frozen=True)
class Given:
    """A rule for a host with its subdomains, and the start of a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
GIVEN = (
    Given("net", "/", "block"),
    Given("example.net", "/en/", "allow"),
    Given("example.com", "/de/", "block"),
    Given("org", "/fr/", "allow"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[Given] = GIVEN) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens_of(url: Column) -> Column:
    """Distinct tokens: the scheme, the host and its parts, words of the path, names of parameters. Numbers are alike."""
    host, path = host_of(url), path_of(url)
    rest = F.regexp_extract(url, _PARTS, 3)

    def named(kind: str, parts: Column) -> Column:
        filled = F.filter(parts, lambda p: p != "")
        return F.transform(filled, lambda p: F.concat(F.lit(kind + "="), p))

    words = F.transform(F.split(path, r"[/._-]+"), lambda p: F.regexp_replace(p, "[0-9]+", "0"))
    names = F.regexp_extract_all(rest, F.lit(r"[?&]([^=&#]+)"), F.lit(1))
    known = F.array_distinct(
        F.concat(
            named("scheme", F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
            named("host", F.array(host)),
            named("part", F.split(host, r"\.")),
            named("path", words),
            named("name", names),
        )
    )
    return F.when(url.contains("://"), known).otherwise(F.array().cast("array<string>"))


def _lower_bound(share: Column, count: Column) -> Column:
    """The lower end of the Wilson interval of a share."""
    z = 1.96
    middle = share + z * z / (2 * count)
    return (middle - z * F.sqrt(share * (1 - share) / count + z * z / (4 * count * count))) / (1 + z * z / count)


RULES = "tokens array<string>, confidence double, support long, key string"


def _identified(rows: DataFrame, of: str) -> DataFrame:
    """``rows`` with two hashes that stand for the column ``of``, which may be very long."""
    return rows.withColumns({"h1": F.xxhash64(of), "h2": F.xxhash64(of, F.lit(1))})


def _met(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (h1, h2, tokens and others), once for each of the stored ``rules`` (key, rule and others) whose tokens they have.

    The inverted index: a rule is listed under its key, its rarest token, and only rows
    that have the key are compared with it. Long rows are not copied for every token.
    """
    size = rules.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "rule"))), F.lit(0)).alias("bytes")).first()
    keys = hinted(rules.select("key").distinct(), size["rows"], size["bytes"])
    held = rows.select("h1", "h2", F.explode("tokens").alias("key")).join(keys, "key", "left_semi")
    held = held.groupBy("h1", "h2").agg(F.collect_list("key").alias("keys"))
    listed = rows.join(held, ["h1", "h2"]).withColumn("key", F.explode("keys"))
    found = listed.join(hinted(rules, size["rows"], size["bytes"]), "key")
    return found.where(F.size(F.array_except("rule", "tokens")) == 0).drop("keys")


def _token_classes(patterns: DataFrame, min_count: int) -> DataFrame:
    """item, members, n, hits, id: tokens that always go together, if ``min_count`` blocked URLs have them. Stored.

    ``item`` is the first of the members and stands for all. Ids ascend with the
    unblocked URLs, so that an item comes before those that it implies.
    """
    each = patterns.select("h1", "h2", "n", "hits", F.explode("tokens").alias("token"))
    stats = each.groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    together = stats.where(F.col("hits") >= min_count).groupBy("n", "hits", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("members"))
    ordered = together.select(F.col("members")[0].alias("item"), "members", "n", "hits").orderBy(F.col("n") - F.col("hits"), "item")
    return written(ordered.withColumn("id", F.monotonically_increasing_id()), "token-classes")


def _merged(rows: DataFrame) -> DataFrame:
    """Rows (prefix, items, n, hits) that can give a pair, equal ones as one. Stored."""
    pairs = rows.where(F.size("items") > 1).groupBy("prefix", "items")
    return written(pairs.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), "url-bases")


def _first_base(patterns: DataFrame, classes: DataFrame) -> DataFrame:
    """prefix, items, n, hits: the URLs as ascending token classes (item, set), of those that can be part of a larger rule."""
    misses = patterns.agg(F.sum(F.col("n") - F.col("hits"))).first()[0]
    joining = classes.where((F.col("n") > F.col("hits")) & (F.col("n") - F.col("hits") < misses))
    each = patterns.select("h1", "h2", "n", "hits", F.explode("tokens").alias("item"))
    entries = find(each, joining.select("item", "n", "id"), ["item"], "n", "id").where("id IS NOT NULL")
    items = F.array_sort(F.collect_list(F.struct(F.col("id").alias("item"), F.col("id").alias("set"))))
    rows = entries.groupBy("h1", "h2", "n", "hits").agg(items.alias("items"))
    return _merged(rows.withColumn("prefix", F.lit(-1).cast("long")))


def _next_bases(rows: DataFrame, sets: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """The conditional bases of each ``rows``' prefix and one item more, and the sets of those with another item, counted.

    An item stays in a base if it is in ``min_count`` blocked URLs and takes an unblocked
    one away; if it takes all away, its set is counted and nothing is added to it.
    """
    each = rows.select(F.posexplode("items").alias("at", "one"), "items", "n", "hits")
    rest = F.transform(F.slice("items", F.col("at") + 2, F.size("items")), lambda i: i["item"])
    based = each.select(F.col("one.set").alias("prefix"), rest.alias("rest"), "n", "hits").where(F.size("rest") > 0)
    based = based.groupBy("prefix", "rest").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    based = written(based.withColumn("row", F.monotonically_increasing_id()), "url-suffixes")
    entries = based.select("prefix", "row", "n", "hits", F.explode("rest").alias("item"))
    stats = entries.groupBy("prefix", "item").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).where(F.col("hits") >= min_count)
    before = sets.select(F.col("set").alias("prefix"), F.col("items").alias("before"), (F.col("n") - F.col("hits")).alias("misses"))
    fewer = stats.join(before, "prefix").where(F.col("n") - F.col("hits") < F.col("misses"))
    named = fewer.select("prefix", "item", F.concat("before", F.array("item")).alias("items"), "n", "hits")
    longer = written(named.withColumn("set", F.monotonically_increasing_id()), "item-sets")
    kept = find(entries, longer.where("n > hits").select("prefix", "item", "n", "set"), ["prefix", "item"], "n", "set").where("set IS NOT NULL")
    items = F.array_sort(F.collect_list(F.struct("item", "set")))
    return _merged(kept.groupBy("prefix", "row", "n", "hits").agg(items.alias("items"))), longer


def _frequent(rows: DataFrame, sets: DataFrame, min_count: int) -> DataFrame | None:
    """items: what FP-growth finds in ``min_count`` blocked URLs of a base or more, two items at least, with the prefix. Stored.

    Items are numbers of sets, prefix included, so bases do not mix. Equal URLs beyond
    ``min_count`` make nothing more frequent and are not repeated.
    """
    copies = F.explode(F.sequence(F.lit(1), F.least("hits", F.lit(min_count)).cast("int")))
    baskets = rows.where("hits > 0").select(F.transform("items", lambda i: i["set"]).alias("items"), copies.alias("copy"))
    baskets = written(baskets.select("items"), "baskets")
    count = baskets.count()
    if count < min_count:
        return None
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // RUN_BASKETS))
    # Half a URL less than the count, so that rounding asks for just the count.
    growth = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / count, numPartitions=parts)
    found = growth.fit(baskets).freqItemsets.where(F.size("items") > 1).select(F.col("items").alias("found"))
    each = found.withColumn("set", F.explode("found")).join(sets.select("set", "items"), "set")
    whole = each.groupBy("found").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return written(whole.select("items"), "frequent-sets")


def _mined(patterns: DataFrame, classes: DataFrame, min_count: int, most_items: int) -> DataFrame:
    """items (ascending ids of classes), n, hits: every set of token classes that may be a rule, counted over all URLs. Stored."""
    rows = _first_base(patterns, classes)
    sets = classes.select(F.lit(-1).cast("long").alias("prefix"), F.array("id").alias("items"), "n", "hits", F.col("id").alias("set"))
    counted, found = sets.select("items", "n", "hits"), []
    while True:
        longest = rows.where("hits > 0").groupBy("prefix").agg(F.max(F.size("items")).alias("longest"))
        width = sets.groupBy("prefix").agg(F.count("*").alias("width"))
        is_long = (F.col("longest") > most_items) | (F.col("width") > RUN_ITEMS)
        bases = written(longest.join(width, "prefix").select("prefix", "width", is_long.alias("is_long")), "bases")
        sizes = bases.agg(F.count_if("is_long").alias("long"), F.sum(F.when(~F.col("is_long"), F.col("width"))).alias("width")).first()
        runs = -(-(sizes["width"] or 0) // RUN_ITEMS)
        short = rows.join(bases.where(~F.col("is_long")).select("prefix"), "prefix", "left_semi")
        for run in range(runs):
            some = short.where(F.pmod(F.xxhash64("prefix"), F.lit(runs)) == run)
            found.append(_frequent(some, sets, min_count))
        if not sizes["long"]:
            break
        long = rows.join(bases.where("is_long").select("prefix"), "prefix", "left_semi")
        rows, sets = _next_bases(long, sets, min_count)
        counted = counted.unionByName(sets.select("items", "n", "hits"))
    frequent = [sets for sets in found if sets is not None]
    if frequent:
        counted = counted.unionByName(_counted(patterns, classes, reduce(DataFrame.unionByName, frequent)))
    return written(counted, "counted-sets")


def _rules_of(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """``sets`` (items and others) with their tokens as ``rule``, and their rarest item as ``key``."""
    each = sets.withColumn("id", F.explode("items")).join(classes.select("id", "item", "members", F.col("n").alias("class_n")), "id")
    tokens = F.array_sort(F.flatten(F.collect_list("members")))
    return each.groupBy(*sets.columns).agg(tokens.alias("rule"), F.min_by("item", F.struct("class_n", "item")).alias("key"))


def _counted(patterns: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """items, n, hits: how many URLs have the tokens of each of the ``sets``, and how many of them are blocked."""
    found = _met(patterns, written(_rules_of(sets, classes), "candidate-rules"))
    return found.groupBy("items").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def _surest(sets: DataFrame, min_confidence: float) -> DataFrame:
    """items, confidence, hits: the sure sets of which no part is at least as sure.

    Sets are compared with those of one item less, which carry the confidence of their
    surest part. One that lacks such a part, or has no fewer misses than it, is no surer
    than that part, and neither is any that contains it.
    """
    misses, share = F.col("n") - F.col("hits"), F.col("hits") / F.col("n")
    rules, level = None, None
    for size in range(1, (sets.agg(F.max(F.size("items"))).first()[0] or 0) + 1):
        own = sets.where(F.size("items") == size)
        if level is None:
            compared = own.withColumn("surest", F.lit(0.0))
        else:
            less = F.transform("items", lambda one: F.filter("items", lambda other: other != one))
            part = level.select(F.col("items").alias("part"), misses.alias("part_misses"), F.greatest(share, "surest").alias("part_surest"))
            met = own.withColumn("part", F.explode(less)).join(part, "part").where(misses < F.col("part_misses"))
            compared = met.groupBy("items", "n", "hits").agg(F.max("part_surest").alias("surest"), F.count("*").alias("parts"))
            compared = compared.where(F.col("parts") == size).drop("parts")
        level = written(compared, "compared-sets")
        if level.isEmpty():
            break
        sure = level.where((share > F.col("surest")) & (_lower_bound(share, F.col("n")) >= min_confidence))
        sure = sure.select("items", share.alias("confidence"), "hits")
        rules = sure if rules is None else rules.unionByName(sure)
    return rules


def mine_rules(
    labelled: DataFrame,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
    most_items: int = MOST_ITEMS,
) -> DataFrame:
    """Rules (``RULES``) from labelled URLs: columns ``tokens`` and ``block``. The result is stored.

    A rule has at least ``min_count`` blocked URLs, and the lower end of its confidence's
    interval is at least ``min_confidence``. One that is no surer than a part of it goes.
    ``most_items`` changes how rules are found, not which.
    """
    spark = labelled.sparkSession
    patterns = labelled.where(F.size("tokens") > 0).groupBy(F.array_sort("tokens").alias("tokens"))
    patterns = patterns.agg(F.count("*").alias("n"), F.count_if(F.col("block")).alias("hits"))
    patterns = written(_identified(patterns, "tokens"), "url-patterns")
    classes = _token_classes(patterns, min_count)
    if classes.isEmpty():
        return spark.createDataFrame([], RULES)
    rules = _rules_of(_surest(_mined(patterns, classes, min_count, most_items), min_confidence), classes)
    return written(rules.select(F.col("rule").alias("tokens"), "confidence", F.col("hits").alias("support"), "key"), "url-rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined: of the distinct URLs that a mined rule matches, the most confident rule's tokens."""
    distinct = _identified(urls.select("url").where("url IS NOT NULL").distinct(), "url").withColumn("tokens", tokens_of(F.col("url")))
    distinct = written(distinct, "urls")
    found = _met(distinct.drop("url"), rules.select("key", F.col("tokens").alias("rule"), "confidence"))
    best = found.groupBy("h1", "h2").agg(F.max(F.struct("confidence", "rule")).alias("best"))
    return distinct.select("h1", "h2", "url").join(best, ["h1", "h2"]).select("url", F.col("best.rule").alias("mined"))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """page id, host, path, rule (the given one, or null), verdict, and the mined rule that matches, for every page."""
    named = pages.select(quoted(key).alias("page_id"), quoted(url).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = named.select("page_id", "url", host.alias("host"), path.alias("path"))
    ruled = parts.withColumn("given", given_rule(F.col("host"), F.col("path")))
    joined = ruled.join(matched(named, rules), "url", "left")
    mined = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("given.name").alias("rule"),
        F.coalesce("given.verdict", mined).alias("verdict"),
        F.array_join("mined", " ").alias("mined_rule"),
    )


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens and block (low quality or toxic) of the pages that have a label of the same id."""
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("block"))
    return pages.join(marks, "page_id").select(tokens_of(F.col("url")).alias("tokens"), "block")


def judged_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The query: every page, by the given rules and those mined from the labels."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    rules = mine_rules(labelled_urls(pages, spark.read.parquet(f"{folder}/labels.parquet")))
    return judge_urls(pages, rules)
