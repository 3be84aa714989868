"""Mix sources to target weights along a curriculum.

Every source has a weight and a ramp, the course its weight takes during training.
Targets share out all words by weight, none beyond `cap` times what its source has;
the excess goes to the others by weight (water-filling, exact). A source's demand up
to training time t is its target times the integral of its ramp. Its documents, in an
order set by a hash of their ids and repeated from the start when they run out, meet
that demand one after the other: each copy starts at the time at which the demand
reaches the words before it. Sorting all copies by that time, range by range, is the
training order.

Defined cases. Null and empty texts have size 0, are never taken and sit at the time
their turn comes. A null source is a source of its own, after all others. Null ids
order first. Repeated rows count each. The copy that crosses its source's target is
cut there, so a source's taken words are its target rounded down. An empty table, or
one without words, gives rows with nothing taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from match_lake.llm.words import SPACE, free_names, one_row_each, row_hash, text_or_empty, word_count
from match_lake.operators.ordering import number_rows
from match_lake.session import cut_lineage

WEIGHTS = (1, 2, 3)
# Weight at the start and at the end of training, as multiples of the weight; each pair has mean 1.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
CAP = 3
# A source's documents are summed up in this many parts of their hash order.
HEX_DIGITS = 3


def cycled(rank: Column, values: Sequence) -> Column:
    """values[(rank - 1) mod n] for a rank from 1."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(rank - 1, F.lit(len(values))).cast("int"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ramps: Sequence = RAMPS, cap: int = CAP) -> DataFrame:
    """source, source_size, target, ramp_start, ramp_end from rows of (source, size).

    The windows run over one row per source. A source is full exactly when its cap is at
    most its share of what the sources with a lower cap per weight leave.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    )
    weighed = ranked.withColumns({
        "_weight": cycled(F.col("_rank"), weights).cast("bigint"),
        "ramp_start": cycled(F.col("_rank"), [float(a) for a, _ in ramps]),
        "ramp_end": cycled(F.col("_rank"), [float(b) for _, b in ramps]),
        "_cap": F.col("source_size") * cap,
    })
    lower = W.orderBy(F.col("_cap") / F.col("_weight"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    left = weighed.withColumns({
        "_words": F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(lower), F.lit(0)),
        "_weights": F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(lower), F.lit(0)),
    }).withColumn("_full", F.col("_cap") * F.col("_weights") <= F.col("_words") * F.col("_weight"))
    shared = left.withColumns({
        "_words": F.sum("source_size").over(everything) - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(everything),
        "_weights": F.sum("_weight").over(everything) - F.sum(F.when(F.col("_full"), F.col("_weight")).otherwise(0)).over(everything),
    })
    share = F.try_divide((F.col("_weight") * F.col("_words")).cast("double"), F.col("_weights").cast("double"))
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share)
    return shared.select("source", "source_size", target.alias("target"), "ramp_start", "ramp_end")


def reached_at(done: Column, target: Column, start: Column, end: Column) -> Column:
    """The time at which a demand of `target` words in all, along a ramp, comes to `done` words.

    With g(t) = start + (end - start) t and mean 1, t solves start t + (end - start) t^2 / 2 = done / target.
    """
    part = F.least(F.lit(1.0), F.try_divide(done.cast("double"), target))
    root = F.sqrt(start * start + F.lit(2.0) * (end - start) * part)
    return F.coalesce(F.try_divide(F.lit(2.0) * part, start + root), F.lit(0.0))


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, ramps: Sequence = RAMPS, cap: int = CAP, hex_digits: int = HEX_DIGITS,
) -> DataFrame:
    """One narrow row per document: id, source, size, source_size, target, taken, before, ramp_start, ramp_end, turn.

    `before` is the number of words of its source ahead of it. It is summed up per part
    of the hash order first, so no task sees more than a part of a source.
    """
    budget, done = F.floor("target"), F.col("before")
    taken = sum(
        (F.greatest(F.lit(0), F.least(F.col("size"), budget - F.lit(turn) * F.col("source_size") - done)) for turn in range(1, cap)),
        F.greatest(F.lit(0), F.least(F.col("size"), budget - done)),
    )
    return _placed(_sized(docs, id_col, text, source), ["id", "size"], weights, ramps, cap, hex_digits).select(
        "id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "before", "ramp_start", "ramp_end", "turn"
    )


def _sized(docs: DataFrame, id_col: str, text: str, source: str, *more: Column) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), F.md5(key).alias("turn"), *more
    )


def _placed(sized: DataFrame, ties: Sequence[str], weights: Sequence[int], ramps: Sequence, cap: int, hex_digits: int) -> DataFrame:
    """The rows of `sized` with source_size, target, before, ramp_start, ramp_end; equal turns come in the order of `ties`.

    `size` is a row's own, and `words` is for that of all rows it stands for, where there is such a column.
    """
    words = F.col("words") if "words" in sized.columns else F.col("size")
    sized = sized.withColumns({"_part": F.substring("turn", 1, hex_digits), "_all": words})
    targets = source_targets(sized.select("source", F.col("_all").alias("size")), weights, ramps, cap)
    parts = sized.groupBy("source", "_part").agg(F.sum("_all").alias("_words"))
    earlier = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.select("source", "_part", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base"))
    # One row per source, at most one per part and source: narrow, and joined by measured size.
    known = bases.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumnsRenamed({"source": "_source", "_part": "_known"})
    inside = W.partitionBy("source", "_part").orderBy("turn", *ties).rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("_all").over(inside), F.lit(0))).join(
        known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_known")), "left"
    )
    return placed.withColumn("before", F.col("_base") + F.col("_inside")).drop("_part", "_all", "_base", "_inside", "_source", "_known")


def in_training_order(copies: DataFrame, *by: str) -> DataFrame:
    """Copies range-sorted by position; the other columns settle what starts at the same time."""
    return copies.repartitionByRange(*by).sortWithinPartitions(*by)


def training_order(plan: DataFrame, cap: int = CAP) -> DataFrame:
    """The copies that the mix takes of the rows of a plan, narrow and numbered in training order, in a written copy.

    place: from 0, over all sources. source, before: the row of the plan (rows with words differ in them). copy: from 0.
    words: what is taken of the copy. position: when it starts.
    """
    turned = plan.filter((F.col("size") > 0) & (F.col("before") < F.floor("target"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))
    )
    done = F.col("copy") * F.col("source_size") + F.col("before")
    copies = turned.withColumn("words", F.least(F.col("size"), F.floor("target") - done)).filter(F.col("words") > 0)
    position = reached_at(done, F.col("target"), F.col("ramp_start"), F.col("ramp_end"))
    placed = copies.select("source", "before", "turn", "copy", "words", position.alias("position"))
    return number_rows(placed, ["position", "turn", "source", "before", "copy"], "place")


def scheduled(plan: DataFrame, cap: int = CAP) -> DataFrame:
    """The rows of a plan in the order in which training first meets them; those it leaves out come when their turn would.

    `taken` and `first_position` are told by the row's copies in the training order. `plan` is read twice.
    """
    met = training_order(plan, cap).groupBy("source", "before").agg(
        F.sum("words").cast("bigint").alias("taken"), F.min("position").alias("_first"), F.min("place").alias("_place")
    ).withColumnsRenamed({"source": "_source", "before": "_before"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("before") == F.col("_before")) & (F.col("size") > 0)
    turn_comes = reached_at(F.col("before"), F.col("target"), F.col("ramp_start"), F.col("ramp_end"))
    rows = plan.drop("taken").join(met, same, "left").withColumns({
        "taken": F.coalesce("taken", F.lit(0).cast("bigint")), "first_position": F.coalesce("_first", turn_comes),
    })
    return in_training_order(rows, "first_position", "_place", "turn").drop("_source", "_before", "_first", "_place")


def first_words(text: str, n: Column) -> Column:
    """The first n words, one space between them."""
    parts = F.filter(F.split(text_or_empty(text), SPACE), lambda word: word != "")
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), " ")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, ramps: Sequence = RAMPS, cap: int = CAP,
) -> DataFrame:
    """The rows of `docs` in training order: each as often as the mix takes it, range-sorted by position.

    Of a copy that the target cuts, the text is its first words. Rows that are equal in all columns are one row of
    the plan that knows how often it comes, so each of them has its own turn, whatever the order they are read in.
    """
    sid, ssrc, ssize, turn, row, times, before, whole, target, start, end, nth, copy, words, position = free_names(
        docs.columns, "_id", "_source", "_size", "_turn", "_row", "_times", "_before", "_whole", "_target", "_start", "_end",
        "_nth", "_copy", "_words", "_position"
    )
    equal = _sized(docs, id_col, text, source, row_hash(docs).alias("row")).groupBy("id", "source", "size", "turn", "row").agg(
        F.count(F.lit(1)).alias("times")
    )
    placed = _placed(equal.withColumn("words", F.col("size") * F.col("times")), ["id", "size", "row"], weights, ramps, cap, HEX_DIGITS)
    # The first copy of the first of equal rows is the one that comes earliest.
    used = placed.filter((F.col("size") > 0) & (F.col("before") < F.floor("target"))).select(
        "id", "source", "size", "turn", "row", "times", "before", "source_size", "target", "ramp_start", "ramp_end"
    ).toDF(sid, ssrc, ssize, turn, row, times, before, whole, target, start, end)
    # Written first, so that its size is known.
    repeated = cut_lineage(equal.filter("times > 1").select("id", "row").toDF(sid, row), "repeated")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(sid)) & (row_hash(docs) == F.col(row))
    alone = docs.join(repeated, same, "left_anti")
    single = alone.unionAll(one_row_each(docs.join(repeated, same, "left_semi"), F.col(f"`{id_col}`"), row_hash(docs)))
    joined = single.join(used.hint("shuffle_hash"), same).withColumn(nth, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(times) - 1)))
    joined = joined.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    done = F.col(copy) * F.col(whole) + F.col(before) + F.col(nth) * F.col(ssize)
    copies = joined.withColumn(words, F.least(F.col(ssize), F.floor(F.col(target)) - done)).filter(F.col(words) > 0).withColumn(
        position, reached_at(done, F.col(target), F.col(start), F.col(end))
    )
    cut = F.when(F.col(words) < F.col(ssize), first_words(text, F.col(words))).otherwise(F.col(text))
    ordered = in_training_order(copies, position, turn, row, copy, nth)
    return ordered.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
