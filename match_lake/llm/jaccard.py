"""Exact similarity join on word shingles with adaptive multi-match prefixes.

Two documents link when 100 * |intersection| >= percent * |union| of their sets of k-word
shingles. Whatever total order shingles are put in, the first |x| - t + l shingles of x
and the first |y| - t + l of y then have l in common, where t is the least overlap a link
needs. The longer the prefix, the more shared shingles a candidate must show.

1. Documents with the same set become one class, so copies cost nothing further.
2. In hash order, prefixes lengthened by `extra` of the set: a class of which fewer than l
   prefix shingles occur elsewhere has no partner and drops out. Most documents do.
3. Shingles of the classes left are counted, all of them, and ordered rare first. A class
   whose rare shingles fill its prefix drops out without a candidate.
4. Each class lengthens its prefix by l - 1 for the l in 1 to `deepest` with the lowest
   estimated cost, which is the postings read plus, for at most (postings / l) candidates, a
   share of its size for verification.
5. First every class is verified against the most central class of its shingles, one pair per
   class. Components of these links are found, and only pairs across components, with one
   side outside its shingle's main component, are joined, filtered by size and
   position, counted against l and verified on the full sets. A class outside meets the members of a main
   component only if enough of its shingles occur in any of them together. So a large group of near
   copies costs its links to one member, not all its pairs, while every link between
   different components is tested.

Each step's tables and shuffles go as soon as the next is written.

Defined cases. Words are runs of anything but space and tab to carriage return, with A-Z in
lower case. A text with fewer than k words is one shingle of all of them; without words, or null, it
has no shingles, is linked with nothing and its own component. Rows that repeat a
document are in its class. A null id takes part, and names a component only when no other
row of it has an id. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake.llm.components import component_labels
from match_lake.llm.steps import Steps
from match_lake.llm.wordhash import mixed, shingles, word_groups
from match_lake.llm.words import free_names, one_row_each

WORDS = 5
PERCENT = 80
# How much of a set the prefixes of step 2 are lengthened by.
EXTRA_PERCENT = 5
# Longest prefix extension of step 4.
DEEPEST = 4
# Cost of verifying a candidate, in postings per shingle of its set.
VERIFY_COST = 0.125


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of every text."""
    for first, last, words in word_groups(column, lower=True):
        grams = shingles(words.hash, k)
        for i, j in zip(words.first[:-1], words.first[1:]):
            if j - i >= k:
                yield np.unique(grams[i : j - k + 1])
            elif j > i:
                whole = shingles(words.hash[i:j], int(j - i)) + np.uint64(j - i)
                yield mixed(whole)
            else:
                yield np.empty(0, np.uint64)


def set_key(hashes: np.ndarray) -> bytes | None:
    return blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def least_overlap(n: Column, percent: int) -> Column:
    """Of a set of n shingles with any partner."""
    return F.ceil(n * percent / F.lit(100))


def _outlines(docs: DataFrame, id_col: str, text: str, k: int, percent: int, extra: int) -> DataFrame:
    """id, text_hash, n, class (null without shingles), prefix in hash order."""
    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for hashes in shingle_sets(batch.column("text"), k):
                n = len(hashes)
                depth = n - (n * percent + 99) // 100 + 1 + n * extra // 100
                sizes.append(n)
                keys.append(set_key(hashes))
                prefixes.append(hashes[: depth if n else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(prefixes)],
                names=["id", "text_hash", "n", "class", "prefix"],
            )

    rows = _rows(docs, id_col, text)
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(outline, f"id {id_type}, text_hash bigint, n bigint, class binary, prefix array<bigint>")


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Id and the hash of the text name a row; rows that share both are the same document."""
    words = F.col(f"`{text}`")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(words).alias("text_hash"), words.alias("text"))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _possible(classes: DataFrame, percent: int, extra: int) -> DataFrame:
    """Classes enough of whose hash-order prefix occurs in other classes.

    A partner has at least t = percent of n shingles, so its prefix is lengthened by at
    least l(t) - 1 as well: l(t) of the shingles must be shared. `node` is short for the
    class; two classes with one node could only let a class stay.
    """
    tokens = classes.select("node", F.explode("prefix").alias("token"))
    repeated = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("token")
    counted = tokens.join(repeated, "token", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    need = F.lit(1) + F.floor(least_overlap(F.col("n"), percent) * extra / F.lit(100))
    return classes.select("class", "node", "n", "rep").join(counted, "node").filter(F.col("shared") >= need)


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """class, n, tokens of the wanted classes, read again from the document that stands for each."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for want, hashes in zip(batch.column("class").to_pylist(), shingle_sets(batch.column("text"), k)):
                if set_key(hashes) == want:
                    keys.append(want)
                    sets.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), _lists(sets)], names=["class", "tokens"])

    rows = _rows(docs, id_col, text).alias("row")
    chosen = wanted.select("class", "rep").alias("chosen")
    same = F.col("row.id").eqNullSafe(F.col("chosen.rep.id")) & (F.col("row.text_hash") == F.col("chosen.rep.text_hash"))
    found = rows.join(chosen, same).select("class", "text")
    sets = found.mapInArrow(read, "class binary, tokens array<bigint>")
    return sets.dropDuplicates(["class"]).withColumn("n", F.size("tokens").cast("bigint"))


def _postings(sets: DataFrame, percent: int, deepest: int) -> DataFrame:
    """class, n, rare, depth, token, at, i: the shared shingles in each class's longest prefix, rare first.

    `rare` shingles occur in no other class and come before all others; i counts the shared
    ones, at = rare + i. `depth` is the l the class probes with.
    """
    tokens = sets.select("class", "n", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = tokens.join(counts, "token").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s"))
    spare = F.col("n") - least_overlap(F.col("n"), percent)
    prefixes = ordered.withColumn("rare", F.col("n") - F.size("s")).withColumn(
        "s", F.slice("s", F.lit(1), F.greatest(F.lit(0), (spare + deepest - F.col("rare"))).cast("int"))
    )
    costs = []
    for depth in range(1, deepest + 1):
        read = F.aggregate(
            F.slice("s", F.lit(1), F.greatest(F.lit(0), (spare + depth - F.col("rare"))).cast("int")),
            F.lit(0).cast("bigint"), lambda total, x: total + x["df"],
        )
        costs.append(F.struct((read + read / depth * F.col("n") * VERIFY_COST).alias("cost"), F.lit(depth).alias("depth")))
    chosen = prefixes.withColumn("depth", F.array_min(F.array(*costs))["depth"]).filter(F.size("s") > 0)
    return chosen.select("class", "n", "rare", "depth", F.posexplode("s").alias("i", "t")).select(
        "class", "n", "rare", "depth", F.col("t.token").alias("token"), "i", (F.col("rare") + F.col("i")).alias("at")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("_a"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    linked = both * 100 >= (F.size("_a") + F.size("_b") - both) * percent
    return pairs.join(left, "a").join(right, "b").filter(linked).select("a", "b")


def _needed(x: str, y: str, percent: int) -> Column:
    """The overlap a link of two sets needs."""
    return F.ceil((F.col(f"{x}.n") + F.col(f"{y}.n")) * percent / F.lit(100 + percent))


def _fits(x: str, y: str, percent: int) -> Column:
    """Whether sizes and rare shingles allow a link."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    common = F.least(nx - F.col(f"{x}.rare"), ny - F.col(f"{y}.rare"))
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (common >= _needed(x, y, percent))


def _star_links(posts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of classes with the most central class of the shingles they share: one pair per class.

    The class with the fewest shingles of its own is most central: of near copies, the text they come from.
    """
    pivots = posts.groupBy("token").agg(F.min(F.struct("rare", "n", "class")).alias("x"))
    met = posts.alias("y").join(pivots, "token").filter((F.col("y.class") != F.col("x.class")) & _fits("x", "y", percent))
    times = met.groupBy("class", F.col("x.class").alias("pivot")).agg(F.count(F.lit(1)).alias("times"))
    best = times.groupBy("class").agg(F.max_by("pivot", F.struct("times", "pivot")).alias("pivot"))
    return _verified(best.select(F.col("pivot").alias("a"), F.col("class").alias("b")), sets, percent)


def _near_parts(strays: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(class, main) of the strays that may link to a class of the main component, (class, n, main) given.

    A link to any of its classes needs as much overlap as one to the smallest class that fits, and no class has more
    of the stray's shingles than the component has in all its classes.
    """
    mains = strays.select(F.col("main").alias("root")).distinct()
    members = labels.join(mains, "root").select(F.col("node").alias("class"), F.col("root").alias("main"))
    members = members.unionAll(mains.select(F.col("root").alias("class"), F.col("root").alias("main")))
    full = members.join(sets, "class")
    least = full.groupBy("main").agg(F.min("n").alias("least"))
    held = full.select("main", F.explode("tokens").alias("token")).distinct()
    own = strays.join(sets.select("class", "tokens"), "class").select("class", "n", "main", F.explode("tokens").alias("token"))
    common = own.join(held, ["main", "token"]).groupBy("class", "n", "main").agg(F.count(F.lit(1)).alias("common"))
    smallest = F.greatest("least", least_overlap(F.col("n"), percent))
    needed = F.ceil((F.col("n") + smallest) * percent / F.lit(100 + percent))
    return common.join(least, "main").filter(F.col("common") >= needed).select("class", "main")


def _cross_pairs(posts: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """Candidate pairs of different components that share enough prefix shingles. Leaves the step "crossing"."""
    labelled = posts.join(labels.withColumnsRenamed({"node": "class"}), "class", "left").withColumn(
        "part", F.coalesce("root", "class")
    ).drop("root")
    main = labelled.groupBy("token").agg(
        F.min_by("part", F.struct("rare", "n", "class")).alias("main"), F.min("part").alias("low"), F.max("part").alias("high")
    ).filter("low <> high").select("token", "main")
    rows = steps.cut(labelled.join(main, "token").withColumn("stray", F.col("part") != F.col("main")), "crossing")
    least_smaller = F.ceil(F.col("x.n") * (2 * percent) / F.lit(100 + percent))
    reach = F.least(F.col("x.i"), F.col("y.i")) + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    condition = (
        (F.col("x.token") == F.col("y.token")) & (F.col("x.part") != F.col("y.part"))
        & (F.struct("x.n", "x.class") < F.struct("y.n", "y.class")) & _fits("x", "y", percent)
        & (F.col("x.at") < F.col("x.n") - least_smaller + F.col("y.depth"))
        & (F.col("y.at") < F.col("y.n") - least_overlap(F.col("y.n"), percent) + F.col("y.depth"))
        & (reach >= _needed("x", "y", percent))
    )
    strays, others = rows.filter("stray"), rows.filter("not stray")
    near = strays.join(_near_parts(strays.select("class", "n", "main").distinct(), sets, labels, percent), ["class", "main"], "left_semi")
    picked = [F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.col("y.depth").alias("depth")]
    shared = reduce(DataFrame.unionAll, [
        x.alias("x").join(y.alias("y"), condition).select(*picked) for x, y in ((strays, strays), (near, others), (others, near))
    ])
    return shared.groupBy("a", "b", "depth").agg(F.count(F.lit(1)).alias("times")).filter("times >= depth").select("a", "b")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT,
    extra: int = EXTRA_PERCENT, deepest: int = DEEPEST,
) -> DataFrame:
    """One row per row of `docs`: id, text_hash, n_shingles, component_id (the smallest id reachable by links), stays."""
    steps = Steps(docs.sparkSession)
    prefixed = steps.cut(_outlines(docs, id_col, text, k, percent, extra), "prefixed")
    # Of a class every row has the same set.
    classes = prefixed.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct("id", "text_hash")).alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
    ).withColumn("node", F.xxhash64("class"))
    possible = steps.cut(_possible(classes, percent, extra), "possible")
    outlines = steps.cut(prefixed.drop("prefix"), "outlines")
    steps.remove("prefixed")
    sets = steps.cut(_sets(docs, possible, id_col, text, k), "sets")
    steps.remove("possible")
    posts = steps.cut(_postings(sets, percent, deepest), "postings")
    stars = steps.cut(_star_links(posts, sets, percent), "stars")
    pairs = steps.cut(_cross_pairs(posts, sets, component_labels(stars, steps, "star_labels"), percent, steps), "pairs")
    steps.remove("postings", "crossing", "star_labels")
    links = steps.cut(stars.union(_verified(pairs, sets, percent)), "links")
    steps.remove("sets", "pairs", "stars")
    labels = component_labels(links, steps)
    steps.remove("links")
    # Names of components with more than one class, then of classes with more than one row.
    row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")
    groups = outlines.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("members"))
    rooted = groups.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    several = rooted.groupBy("root").agg(F.min("first").alias("lead"), F.sum("members").alias("members")).filter("members > 1")
    named = rooted.join(several.select("root", "lead"), "root").select("class", "lead")
    found = outlines.join(named, "class", "left").select(
        F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"), F.coalesce("lead.id", "id").alias("component_id"),
        F.coalesce(row == F.col("lead"), F.lit(True)).alias("stays"),
    )
    out = steps.cut(found, "similar")
    steps.remove("outlines", "labels")
    return out


def drop_similar(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """The rows of `docs` without those that are linked to a row that stays, or through others to it.

    Of a component the row with the smallest id stays, of rows sharing it the one with the smallest
    text hash; of rows that repeat both, also texts without words, the one with the smallest hash of all columns.
    """
    gone, digest, stays, rows = free_names(docs.columns, "_gone", "_digest", "_stays", "_rows")
    found = similar_components(docs, id_col, text, k, percent)
    keys = found.groupBy(F.col(id_col).alias(gone), F.col("text_hash").alias(digest)).agg(
        F.max("stays").alias(stays), F.count(F.lit(1)).alias(rows)
    )
    # Written first, so that its size is known.
    marks = Steps(docs.sparkSession).cut(keys.filter(~F.col(stays) | (F.col(rows) > 1)).select(gone, digest, stays), "marks")
    own, hashed = F.col(f"`{id_col}`"), F.xxhash64(f"`{text}`")
    same = own.eqNullSafe(F.col(gone)) & (hashed == F.col(digest))
    alone = docs.join(marks, same, "left_anti")
    repeated = docs.join(marks.filter(F.col(stays)), same, "left_semi")
    return alone.unionAll(one_row_each(repeated, own, hashed))
