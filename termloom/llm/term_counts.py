"""How often every distinct term occurs, in how many records, and which terms are too rare or too common (problem 1).

Last-seen counters: tokens are hash-partitioned by term and ordered by record inside the partition.  Walking along
them, a counter needs the occurrences, the records and the last record identifier only: a record is new exactly where
it differs from the one before.  No set of records is kept for any term.

A term may hold a third of all tokens, so each term has several counters, chosen by the hash of the record; a record
meets one counter of a term only, so the counters add up exactly.  Their number follows that of the shuffle partitions,
and so the data: the largest counter stays a fraction of a mean partition.  They are merged in a second, small step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .terms import term

#: Counters of a term: at least so many, and so many for each shuffle partition.
SALTS, SALTS_A_PARTITION = 32, 4
RARE_BELOW = 3


def term_counts(values: DataFrame, common: dict[str, float], rare_below: int = RARE_BELOW) -> DataFrame:
    """(field_name, term, occurrences, records, total_records, is_rare, is_common) of ``values`` (field_name, rec_id, raw_value).

    ``common`` has, by field, the share of the field's records (those with any term) above which a term is common;
    fields it does not name have no common terms.  Null and blank values are no terms; null records are left out;
    repeated rows count as occurrences, not as records; a term may be both rare and common where there are few records."""
    tokens = values.select("field_name", term(F.col("raw_value")).alias("term"), "rec_id").where(F.col("term").isNotNull() & F.col("rec_id").isNotNull())
    salts = max(SALTS, SALTS_A_PARTITION * int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tokens = tokens.withColumn("salt", F.pmod(F.xxhash64("rec_id"), F.lit(salts)).cast("int"))
    seen = Window.partitionBy("field_name", "term", "salt").orderBy("rec_id")
    counters = (
        tokens.withColumn("new", (~F.lag("rec_id").over(seen).eqNullSafe(F.col("rec_id"))).cast("long"))
        .groupBy("field_name", "term", "salt")
        .agg(F.count("*").alias("occurrences"), F.sum("new").alias("records"))
    )
    counts = counters.groupBy("field_name", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    totals = tokens.select("field_name", "rec_id").distinct().groupBy("field_name").agg(F.count("*").alias("total_records"))
    share = F.lit(None).cast("double")
    for field, x in common.items():
        share = F.when(F.col("field_name") == field, F.lit(float(x))).otherwise(share)
    return (
        counts.join(F.broadcast(totals), "field_name")  # a row a field
        .withColumn("is_rare", F.col("records") < rare_below)
        .withColumn("is_common", F.coalesce(F.col("records") > F.col("total_records") * share, F.lit(False)))
    )


def marks(counts: DataFrame) -> DataFrame:
    """(field_name, term, mark) of the terms that are ``rare`` or ``common``; a row for each mark."""
    mark: Column = F.explode(F.filter(F.array(F.when(F.col("is_rare"), "rare"), F.when(F.col("is_common"), "common")), lambda x: x.isNotNull()))
    return counts.select("field_name", "term", mark.alias("mark"))
