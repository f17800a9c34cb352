"""Near-duplicate documents from bottom-k sketches of their word shingles.

A document's set holds its distinct 5-word shingles, A-Z lower-cased, as 64-bit hashes.
Two documents are linked when 100 * intersection >= 75 * union, confirmed on full sets.

1. Each text's set is hashed once; its ``K`` smallest hashes are its sketch, stored
   with the size and a 128-bit digest of the set. Equal sets form a class, and one
   document stands for it from here on.
2. Inverted lists of the retained values give candidates. Two sets with similarity
   0.75 share at least ``SHARED`` of 64 values but for one pair in 10^7, so:
   - a list of up to ``HOT`` documents gives its pairs;
   - a longer list matters only for documents of which at least ``SHARED`` of 64 values
     are in long lists. Each of these is paired with the list's most central document.
3. The bottom-k of the union of two sketches estimates their similarity; pairs
   clearly below the threshold go.
4. Documents of the long lists form families around a common document. A family's pivot
   is the set of what most of its members hold, and its hub the member closest to that.
   Sets differ as much as their differences from the pivot do, so one comparison of each
   member with its hub links all that are similar to that. The best candidate of every
   document is confirmed on full sets, which with these links joins most large groups.
   Then every candidate across two groups is confirmed.
5. What is left in long lists lies across groups. Within a family, a prefix filter over
   the differences from the pivot, which hold what is rare in the family, gives the
   candidates. Across families a prefix filter over full sets does. In both, a pair goes
   at once where the parities of two sets in a few hundred buckets differ in more places
   than similar sets differ in elements. All is exact: no pair is cut off by a cap, and
   what is never compared is already in one group, or cannot be similar.

Nulls and odd input: a null text is empty; a text without words has an empty set and
is linked with nothing. A row with a null id is linked with nothing, has a null
component and is kept. Rows are compared on their own: repeated rows are equal sets.
An empty table gives an empty one. Other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.arrow import Texts, map_texts, quoted
from tokenloom.llm.components import components
from tokenloom.llm.lookup import find
from tokenloom.llm.words import mix, shingle_sets
from tokenloom.plans.sizes import hinted
from tokenloom.plans.workspace import written

SIMILAR = 75  # percent
K = 64
FEW = 24  # values used by a document without values in long lists: 0.25^24 is nothing
HOT = 16
SHARED = 0.4
LEADER_LISTS = 3
STEP = 1.05
PARITY = 8  # longs
FINER = 1.1  # sizes that differ by less than this may share a second hub
MEMBERS = 500  # of a family, for each copy of its pivot's set

SKETCH = "n_shingles long, s1 long, s2 long, sketch array<long>"


def _longs(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    values = np.concatenate([*sets, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sets(part: pa.RecordBatch) -> list[np.ndarray]:
    """Sorted as signed numbers, which is the order of Spark's arrays too."""
    return [np.sort(s.view(np.int64)) for s in shingle_sets(Texts(part.column("text")))]


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, s1 and s2 (a digest of the set), sketch."""

    def run(part):
        sets = _sets(part)
        sums = [
            [int(mix(s.view(np.uint64) ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            for salt in (1, 2)
        ]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        return [sizes, pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), _longs([s[:K] for s in sets])]

    named = docs.select(quoted(key).alias("id"), quoted(text).alias("text"))
    return map_texts(named, "text", run, SKETCH, keep=["id"])


def _similar_sizes(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= SIMILAR * F.greatest(a, b)


def _least_hot() -> Column:
    """The number of values in long lists from which on a document may have all it shares in them."""
    return F.ceil(SHARED * F.least(F.col("n_shingles"), F.lit(K)))


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """a, b and the similarity that the bottom-k of the union of two sketches gives."""
    one = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("left"))
    two = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("right"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b")
    common = F.array_intersect("left", "right")
    union = joined.select("a", "b", common.alias("common"), F.slice(F.array_sort(F.array_union("left", "right")), 1, K).alias("least"))
    share = F.size(F.array_intersect("least", "common")) / F.size("least")
    return union.select("a", "b", share.alias("estimate")).where(F.col("estimate") >= SHARED)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar enough by their full sets."""
    one = sets.select(F.col("rep").alias("a"), F.col("set").alias("left"))
    two = sets.select(F.col("rep").alias("b"), F.col("set").alias("right"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b")
    sized = joined.select(
        "a", "b", F.size(F.array_intersect("left", "right")).alias("both"), (F.size("left") + F.size("right")).alias("sum")
    )
    return sized.where(100 * F.col("both") >= SIMILAR * (F.col("sum") - F.col("both"))).select("a", "b").distinct()


def in_groups(nodes: DataFrame, groups: DataFrame, node: str, name: str) -> DataFrame:
    """``nodes`` with the group of the column ``node``; a node without links is its own."""
    found = groups.select(F.col("node").alias(node), F.col("component").alias("_group"))
    return nodes.join(found, node, "left").withColumn(name, F.coalesce("_group", node)).drop("_group")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs of nodes of different groups."""
    marked = in_groups(in_groups(pairs, groups, "a", "group_a"), groups, "b", "group_b")
    return marked.where("group_a <> group_b").select("a", "b")


def candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of short lists; and rep, family (stored) of the documents that may meet in long lists only."""
    values = reps.select("rep", "n_shingles", F.posexplode("sketch").alias("place", "value"))
    shared = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    entries = values.join(shared, "value")
    by_rep = entries.groupBy("rep", "n_shingles").agg(
        F.collect_list(F.when(F.col("df") <= HOT, F.struct("place", "value"))).alias("few"),
        F.collect_list(F.when(F.col("df") > HOT, F.col("value"))).alias("hot"),
        F.sum(F.log2("df")).alias("centre"),
    )
    listed = written(by_rep, "listed")

    short = listed.withColumn("entry", F.explode("few")).where((F.size("hot") > 0) | (F.col("entry.place") < FEW))
    short = short.select("rep", "n_shingles", F.col("entry.value").alias("value"))
    other = short.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), "value")
    pairs = (
        short.withColumnRenamed("rep", "a")
        .join(other, "value")
        .where((F.col("a") < F.col("b")) & _similar_sizes("n_shingles", "n_b"))
        .select("a", "b")
    )

    hot = listed.where(F.size("hot") >= _least_hot()).select("rep", "centre", F.array_sort("hot").alias("hot"))
    first = hot.select("rep", "centre", F.explode(F.slice("hot", 1, LEADER_LISTS)).alias("value"))
    order = F.struct("centre", -F.col("rep"))
    leaders = first.groupBy("value").agg(F.count("*").alias("n"), F.max(order).alias("leader"))
    led = find(first, written(leaders, "leaders"), ["value"], "n", "leader")
    families = led.groupBy("rep").agg((-F.max("leader")["col2"]).alias("family"))
    return pairs.distinct(), written(families, "families")


def _differences(families: DataFrame, sets: DataFrame) -> DataFrame:
    """rep, family, parity, n, m, diff: what only one of a set and its family's pivot holds, and the sizes. The result is stored.

    A pivot holds what more than half of the family's sets hold, so it is no longer than
    two of them. It is copied for every ``MEMBERS`` members, so a large family is dealt out.
    """
    sizes = written(families.groupBy("family").agg(F.count("*").alias("members")), "family-sizes")
    members = find(families, sizes, ["family"], "members", "members").join(sets, "rep")
    values = members.select("family", "members", F.explode("set").alias("value"))
    common = values.groupBy("family", "value").agg(F.count("*").alias("holders"), F.max("members").alias("members"))
    pivots = common.where("2 * holders > members").groupBy("family").agg(F.collect_list("value").alias("pivot"))
    last = F.floor((F.col("members") - 1) / MEMBERS).cast("int")
    pivots = sizes.join(pivots, "family", "left").select(
        "family", F.coalesce("pivot", F.array().cast("array<long>")).alias("pivot"), F.explode(F.sequence(F.lit(0), last)).alias("copy")
    )
    members = members.withColumn("copy", F.pmod(F.xxhash64("rep"), last + 1).cast("int"))
    joined = members.join(pivots, ["family", "copy"])
    diff = F.concat(F.array_except("set", "pivot"), F.array_except("pivot", "set"))
    sized = joined.select("rep", "family", "parity", F.size("set").alias("n"), diff.alias("diff"))
    return written(sized.withColumn("m", F.size("diff")), "differences")


def _hubs(differences: DataFrame) -> DataFrame:
    """rep, family, n, m, hub, room, linked. The result is stored.

    ``hub``: the member of the family that differs least from the pivot; ``room``: n - 7 m
    of it; ``linked``: whether a member is similar to it.
    """
    room = F.struct((F.col("n") - 7 * F.col("m")).alias("room"), (-F.col("rep")).alias("rep"))
    most = differences.groupBy("family").agg(F.count("*").alias("members"), F.max(room).alias("most"))
    hubs = most.select("family", "members", (-F.col("most.rep")).alias("hub"), F.col("most.room").alias("room"))
    hubs = written(hubs.withColumn("own", F.struct("hub", "room", "members")), "hubs")
    last = F.floor((F.col("members") - 1) / MEMBERS).cast("int")
    of_hub = differences.select(F.col("rep").alias("hub"), F.col("n").alias("n_h"), F.col("m").alias("m_h"), F.col("diff").alias("diff_h"))
    copies = hubs.join(of_hub, "hub").select("hub", "n_h", "m_h", "diff_h", F.explode(F.sequence(F.lit(0), last)).alias("copy"))
    placed = find(differences.select("rep", "family", "n", "m", "diff"), hubs, ["family"], "members", "own")
    placed = placed.select("rep", "family", "n", "m", "diff", "own.*").withColumn("copy", F.pmod(F.xxhash64("rep"), last + 1).cast("int"))
    both = F.size(F.array_intersect("diff", "diff_h"))
    linked = 7 * (F.col("m") + F.col("m_h") - 2 * both) <= F.col("n") + F.col("n_h")
    return written(placed.join(copies, ["hub", "copy"]).select("rep", "family", "n", "m", "hub", "room", linked.alias("linked")), "members")


def _within_families(differences: DataFrame, hubs: DataFrame, groups: DataFrame) -> DataFrame:
    """Candidate pairs of one family, of which at least one is not in its hub's group.

    With X and Y the differences of x and y from the pivot, x and y are similar when
    |X| + |Y| - 2 |X & Y| <= (|x| + |y|) / 7. Without anything shared that asks for
    7 |X| - |x| <= |y| - 7 |Y|, the room of y. Nobody has more room than the hub, so whoever
    fits into the hub's is similar to it, and linked. A seeker x does not fit, so at least
    (|Y| + (room - |y|) / 7) / 2 of Y must be in X: the first shared one, rarest first,
    stands in Y's other half.
    """
    placed = in_groups(in_groups(hubs, groups, "rep", "group"), groups, "hub", "home")
    elements = placed.join(differences.select("rep", "diff"), "rep")
    elements = elements.select("rep", "n", "m", "room", "family", "group", "home", F.explode("diff").alias("value"))
    shared = written(elements.groupBy("family", "value").agg(F.count("*").alias("df")).where("df > 1"), "shared-differences")
    found = find(elements, shared.withColumn("weight", F.col("df")), ["family", "value"], "weight", "df")
    rarity = Window.partitionBy("rep").orderBy(F.coalesce("df", F.lit(1)), "value")
    entries = written(found.withColumn("pos", F.row_number().over(rarity)).where("df IS NOT NULL"), "ordered-differences")

    parities = differences.select("rep", "parity")
    seekers = entries.where("group <> home AND 3 * (pos - 1) <= n").select("rep", "n", "m", "pos", "family", "group", "value")
    seekers = seekers.join(parities, "rep")
    listed = entries.where("14 * (pos - 1) <= 7 * m + n - room").join(parities, "rep").select(
        "family",
        "value",
        F.col("rep").alias("rep_l"),
        F.col("n").alias("n_l"),
        F.col("m").alias("m_l"),
        F.col("pos").alias("pos_l"),
        F.col("group").alias("group_l"),
        F.col("parity").alias("parity_l"),
    )
    # No more differences are shared from the first shared one on than what is left of either.
    apart = "group <> group_l AND 7 * (m + m_l - 2 * (1 + least(m - pos, m_l - pos_l))) <= n + n_l"
    meeting = seekers.join(listed, ["family", "value"]).where(apart).where(_may_be_similar("n", "parity", "n_l", "parity_l"))
    return meeting.select(F.least("rep", "rep_l").alias("a"), F.greatest("rep", "rep_l").alias("b")).distinct()


def _rarest_first(families: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """rep, n, group, family, value, pos: the shingles of the documents in ``families``, rarest among these first.

    ``pos`` counts from 1. Shingles of one document alone are counted and left out.
    """
    full = families.join(sets, "rep")
    full = in_groups(full.select("rep", "family", F.size("set").alias("n"), "set"), groups, "rep", "group")
    entries = full.select("rep", "n", "group", "family", F.explode("set").alias("value"))
    shared = written(entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared-shingles")
    found = find(entries, shared.withColumn("weight", F.col("df")), ["value"], "weight", "df")
    rarity = Window.partitionBy("rep").orderBy(F.coalesce("df", F.lit(1)), "value")
    return found.withColumn("pos", F.row_number().over(rarity)).where("df IS NOT NULL")


def across_families(families: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Candidate pairs of different families and groups among the documents that may meet in long lists only.

    Exact prefix filter over full sets in order of rarity: with s <= l the sizes of a
    pair, at least 3/7 (s + l) shingles are shared, so the first shared one stands no
    later than s - 3/7 (s + l) + 1 and l - 3/7 (s + l) + 1. Sizes are part of the
    join's key (in steps of ``STEP``), so that the larger document looks up a shingle
    only for the sizes that its position leaves open. A document far from all others
    begins with shingles of its own and looks up little or nothing.

    Per key only documents outside its largest family look for partners: keys within one
    family make no pair, and the members of a large family are not compared here.
    """
    entries = written(_rarest_first(families, sets, groups), "rarest-first")
    n, pos = F.col("n"), F.col("pos")

    def step(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / math.log(STEP)).cast("int")

    carried = ["rep", "n", "pos", "group", "family", "value"]
    small = entries.where(pos <= n - F.ceil(6 * n / 7) + 1).select(*carried, step(n).alias("step"))
    most = F.least(n, F.floor(7 * (n + 1 - pos) / 3 - n).cast("int"))
    least = F.ceil(n * SIMILAR / 100).cast("int")
    large = entries.where(most >= least).select(*carried, F.explode(F.sequence(step(least), step(most))).alias("step"))
    keys = ["value", "step"]
    sizes = small.select(*keys, "family").union(large.select(*keys, "family")).groupBy(*keys, "family").count()
    mixed = sizes.groupBy(*keys).agg(F.count("*").alias("families"), F.max_by("family", F.struct("count", "family")).alias("main"))
    mixed = written(mixed.where("families > 1").select(*keys, "main"), "mixed-keys")
    parities = sets.select("rep", "parity")
    small = small.join(mixed, keys).join(parities, "rep")
    large = large.join(mixed.withColumnRenamed("main", "main_l"), keys).join(parities, "rep").select(
        *keys,
        F.col("rep").alias("rep_l"),
        F.col("n").alias("n_l"),
        F.col("pos").alias("pos_l"),
        F.col("group").alias("group_l"),
        F.col("family").alias("family_l"),
        F.col("parity").alias("parity_l"),
        "main_l",
    )
    similar = _may_be_similar("n", "parity", "n_l", "parity_l")
    # No more is shared from a pair's first shared shingle on than what is left of either document.
    apart = "family <> family_l AND group <> group_l AND n <= n_l AND 7 * (1 + least(n - pos, n_l - pos_l)) >= 3 * (n + n_l)"
    pairs = [
        small.where("family <> main").join(large, keys).where(apart).where(similar),
        small.where("family = main").join(large.where("family_l <> main_l"), keys).where(apart).where(similar),
    ]
    ends = [p.select(F.least("rep", "rep_l").alias("a"), F.greatest("rep", "rep_l").alias("b")) for p in pairs]
    return ends[0].union(ends[1]).distinct()


def _parities(sets: list[np.ndarray]) -> pa.Array:
    """For each set, which of ``64 * PARITY`` buckets hold an odd number of its hashes, as bits.

    What two sets share cancels out, so their parities differ in at most as many buckets
    as the sets differ in elements.
    """
    buckets = 64 * PARITY
    odd = [np.bincount(s.view(np.uint64) % np.uint64(buckets), minlength=buckets).astype(np.uint8) & 1 for s in sets]
    return _longs([np.packbits(o).view(np.int64) for o in odd])


def _may_be_similar(n: str, parity: str, n_l: str, parity_l: str) -> Column:
    """Whether two sets of these sizes and parities can differ in as few elements as similar ones do."""
    differing = F.zip_with(parity, parity_l, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return 7 * F.aggregate(differing, F.lit(0), lambda done, x: done + x) <= F.col(n) + F.col(n_l)


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """rep, set, parity: the sets of the documents in ``wanted`` (stored, one column ``rep``)."""
    count = wanted.count()
    named = docs.select(quoted(key).alias("rep"), quoted(text).alias("text"))
    texts = named.join(hinted(wanted, count, 8 * count), "rep", "left_semi")

    def run(part):
        sets = _sets(part)
        return [_longs(sets), _parities(sets)]

    return map_texts(texts, "text", run, "`set` array<long>, parity array<long>", keep=["rep"])


def near_links(docs: DataFrame, reps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Components (node, component) over the documents that stand for their class."""
    pairs, families = candidates(reps)
    estimated = written(_estimated(pairs, reps), "candidates")
    ends = estimated.select(F.col("a").alias("rep")).union(estimated.select(F.col("b").alias("rep"))).union(families.select("rep"))
    sets = written(full_sets(docs, written(ends.distinct(), "ends"), key, text), "sets")

    differences = _differences(families, sets)
    hubs = _hubs(differences)
    # Members far from their hub, such as shortened copies, get another hub among those of about their size.
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(FINER)).alias("size")
    left = hubs.where("NOT linked").select("rep", F.xxhash64("family", size).alias("family"))
    finer = _hubs(_differences(written(left, "families"), sets))
    near_hub = hubs.select("rep", "hub", "linked").union(finer.select("rep", "hub", "linked")).where("linked AND rep <> hub")
    stars = near_hub.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    sides = estimated.select(F.col("a").alias("node"), "a", "b", "estimate").union(
        estimated.select(F.col("b").alias("node"), "a", "b", "estimate")
    )
    best = sides.groupBy("node").agg(F.max(F.struct("estimate", -F.col("a"), -F.col("b"))).alias("best"))
    first = best.select((-F.col("best.col2")).alias("a"), (-F.col("best.col3")).alias("b")).distinct()
    links = written(confirmed(first, sets).union(stars), "confirmed")
    groups = written(components(links), "groups")

    rest = _across(estimated, groups).join(first, ["a", "b"], "left_anti")
    within, across = _within_families(differences, hubs, groups), across_families(families, sets, groups)
    rest = rest.union(_estimated(within.union(across), reps).select("a", "b")).distinct()
    more = written(confirmed(rest, sets), "confirmed")
    return components(links.union(more))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept for every row of ``docs``."""
    table = written(sketches(docs, key, text), "sketches")
    classed = table.where("id IS NOT NULL AND n_shingles > 0").groupBy("n_shingles", "s1", "s2")
    reps = classed.agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    reps = written(reps, "classes")
    groups = near_links(docs, reps, key, text)
    joined = in_groups(reps.select("n_shingles", "s1", "s2", "rep", "copies"), groups, "rep", "component_id")
    moved = written(joined.where("copies > 1 OR component_id <> rep"), "moved")
    rows = table.where("id IS NOT NULL").select("id", "n_shingles", "s1", "s2")
    found = find(rows, moved, ["n_shingles", "s1", "s2"], "copies", "component_id")
    result = found.select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    result = result.withColumn("kept", F.col("id") == F.col("component_id"))
    unnamed = table.where("id IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return result.union(unnamed)


def near_duplicate_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: set size, component and verdict of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")


def keep_first(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pipeline's stage: of each group of near-duplicates, the document with the smallest id."""
    gone = near_duplicates(docs).where("NOT kept").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(quoted(c) for c in docs.columns))
