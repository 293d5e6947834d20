"""Mixing sources to target weights (problem 7).

Each source gets a budget: its target share of the total size in tokens.  Its records are put in a random but fixed
order (a hash of the record's id), the token counts are summed along that order, and the order is cut where the budget is
reached; a source smaller than its budget is repeated in whole epochs before the cut, at most ``max_repeats`` times.

Sums along the order are distributed: the hash range is cut into equal ranges, in which the records of a source
are sorted and summed on their own; the sums of whole ranges, a bounded table, give each range its offset.  What
comes out is one cut a source, so the texts themselves are never moved: the mixture is a filter of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import checkpointed

from .bpe import with_token_count

#: A source is sorted in equal ranges of its 64-bit hashes, 4096 of them; each is one group of a window.
RANGE_SHIFT = 52
SEED = 71
#: A share this near to its goal is reached.
TOLERANCE = 0.005


def _key(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit(seed))


def plan_mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", total_tokens: int | None = None, vocabulary: str | None = None, seed: int = SEED) -> DataFrame:
    """A row for each source of ``targets`` (source, target_share, max_repeats): n_docs and n_tokens it has, budget, epochs
    (whole repetitions), cut_key and cut_id (the last record of the epoch that is begun, null if none), taken_docs,
    taken_tokens, actual_share, goal_share (the target among the sources that have tokens) and reached (whether it was).

    ``total_tokens``: the size of the mixture; by default the largest at which every source that has tokens reaches its
    target with its ``max_repeats``.  Shares are relative to their sum over the sources that have any tokens: an empty
    source gets nothing, and its share is spread over the others.  A source that can't fill its budget gives all it may.
    A record is taken while the sum with it stays within the budget.  Null ids, null and blank sources and texts without
    tokens are never taken; a repeated id is taken or left as one.  Null or non-positive shares and repeats count as 0;
    a source listed twice has the sum of its shares and the larger number of repeats."""
    wanted = targets.groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats")).where("source is not null")
    sizes = with_token_count(docs.select(F.col(id_col).alias("id"), "source", F.col(text_col).alias("text")), "text", vocabulary)
    sizes = sizes.join(wanted.select("source"), "source", "left_semi").where("id is not null and n_tokens > 0")
    sizes = sizes.select("source", F.col("id").cast("string").alias("id"), _key("id", seed).alias("key"), "n_tokens")
    sizes = checkpointed(sizes)  # two readers, and texts are encoded once
    sizes = sizes.withColumn("range", F.shiftright("key", RANGE_SHIFT).cast("int"))
    # records of one id are one place in the order
    ranges = sizes.groupBy("source", "range").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source", "range", *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(f"{c}_before") for c in ("tokens", "docs")])

    own = ranges.groupBy("source").agg(F.sum("tokens").alias("n_tokens"), F.sum("docs").alias("n_docs"))
    goal = wanted.join(own, "source", "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0))).withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    able = (F.col("n_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    all_ = Window.partitionBy(F.lit(0))  # a row a listed source
    goal = goal.withColumn("share", F.when(able, F.col("target_share")).otherwise(0.0) / F.nullif(F.sum(F.when(able, F.col("target_share")).otherwise(0.0)).over(all_), F.lit(0.0)))
    largest = F.min(F.when(able, F.col("n_tokens") * F.col("max_repeats") / F.nullif("share", F.lit(0.0)))).over(all_)
    goal = goal.withColumn("total", F.coalesce(F.lit(total_tokens).cast("double") if total_tokens is not None else largest, F.lit(0.0)))
    goal = goal.withColumn("budget", F.least(F.floor(F.coalesce(F.col("total") * F.col("share"), F.lit(0.0)) + 1e-6), F.col("n_tokens") * F.col("max_repeats")).cast("long"))
    goal = goal.withColumn("epochs", F.when(F.col("n_tokens") > 0, F.floor(F.col("budget") / F.nullif("n_tokens", F.lit(0)))).otherwise(0).cast("int"))
    goal = goal.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("n_tokens"))

    # only the range in which the budget is reached is looked into: the sums before it are known
    here = offsets.join(F.broadcast(goal.select("source", "rest")), "source")  # a row a listed source
    last = here.where(F.col("tokens_before") <= F.col("rest")).groupBy("source").agg(F.max_by(F.struct("range", "tokens_before", "docs_before", "rest"), "range").alias("l")).select("source", "l.*")
    inside = sizes.join(F.broadcast(last), ["source", "range"])
    places = inside.groupBy("source", "key", "id").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("docs"), F.first("tokens_before").alias("tokens_before"), F.first("docs_before").alias("docs_before"), F.first("rest").alias("rest"))
    along = Window.partitionBy("source").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    summed = places.withColumn("upto", F.col("tokens_before") + F.sum("n_tokens").over(along)).withColumn("docs_upto", F.col("docs_before") + F.sum("docs").over(along))
    cut = summed.where(F.col("upto") <= F.col("rest")).groupBy("source").agg(F.max_by(F.struct("key", "id", "upto", "docs_upto"), F.struct("key", "id")).alias("c"))
    # where not even the first record of that range fits, the cut is the end of the range before
    edge = last.select("source", F.when(F.col("docs_before") > 0, F.shiftleft(F.col("range").cast("long"), RANGE_SHIFT) - 1).alias("edge"), "tokens_before", "docs_before")
    out = goal.join(edge, "source", "left").join(cut, "source", "left")
    out = out.withColumn("part_tokens", F.coalesce("c.upto", "tokens_before", F.lit(0))).withColumn("part_docs", F.coalesce("c.docs_upto", "docs_before", F.lit(0)))
    out = out.withColumn("taken_tokens", F.col("epochs") * F.col("n_tokens") + F.col("part_tokens")).withColumn("taken_docs", F.col("epochs") * F.col("n_docs") + F.col("part_docs"))
    share = F.col("taken_tokens") / F.nullif(F.sum("taken_tokens").over(all_), F.lit(0))
    return out.select(
        "source", "target_share", "max_repeats", "n_docs", "n_tokens", "budget", "epochs",
        F.when(F.col("part_tokens") > 0, F.coalesce("c.key", "edge")).alias("cut_key"), F.when(F.col("part_tokens") > 0, F.col("c.id")).alias("cut_id"),
        "taken_docs", "taken_tokens", F.coalesce(share, F.lit(0.0)).alias("actual_share"),
        F.coalesce("share", F.lit(0.0)).alias("goal_share"), (able & F.coalesce(F.abs(share - F.col("share")) <= TOLERANCE, F.lit(False))).alias("reached"),
    )


def mix(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """The mixture: the rows of ``docs`` as often as ``plan`` takes them, with ``copy`` (1, 2, ...); map-only.

    ``plan`` has a row a listed source."""
    cuts = F.broadcast(plan.where("taken_tokens > 0").select(*[F.col(c).alias(f"__{c}") for c in ("source", "epochs", "cut_key", "cut_id")]))
    key, rec = _key(id_col, seed), F.col(id_col).cast("string")
    within = (key < F.col("__cut_key")) | (key == F.col("__cut_key")) & (F.col("__cut_id").isNull() | (rec <= F.col("__cut_id")))
    times = F.col("__epochs") + F.when(F.coalesce(within, F.lit(False)), 1).otherwise(0)
    rows = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0)).join(cuts, docs["source"] == F.col("__source"))
    rows = rows.withColumn("__n", times).where("__n > 0")
    return rows.select(*[docs[c] for c in docs.columns if c != "copy"], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
