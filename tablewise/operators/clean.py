"""Cleaning and reshaping: rule checks, exact duplicates, JSON fields,
pivots, hash splits, standard scores, out-of-fold target encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..functions.numeric import safe_div
from ..functions.text import content_key
from ..plans.broadcast import broadcast_per_group
from ..plans.keys import join_on_keys, skew_join
from ..plans.lineage import materialize


def rule_violations(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Integrity rules, one output row per offending key:

    * ``duplicate_line_key``: (l_orderkey, l_linenumber) on more than one line;
    * ``line_without_order``: l_orderkey absent from orders;
    * ``order_without_customer``: o_custkey absent from customer;
    * ``shipped_before_order``: l_shipdate earlier than the order's date.

    Columns: rule, key_a, key_b, n (offending rows for that key). Lines are
    counted per key in each map task before any join, so an order with very
    many lines is one row per task and count, not its lines.
    """
    dup = (lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1)
           .select(F.lit("duplicate_line_key").alias("rule"), F.col("l_orderkey").alias("key_a"),
                   F.col("l_linenumber").cast("bigint").alias("key_b"), "n"))
    order_keys = orders.select(F.col("o_orderkey").alias("l_orderkey")).distinct()
    orphan_lines = (lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
                    .join(order_keys, "l_orderkey", "left_anti")
                    .select(F.lit("line_without_order").alias("rule"), F.col("l_orderkey").alias("key_a"),
                            F.lit(None).cast("bigint").alias("key_b"), "n"))
    cust_keys = customer.select(F.col("c_custkey").alias("o_custkey")).distinct()
    orphan_orders = (orders.select("o_orderkey", "o_custkey").join(cust_keys, "o_custkey", "left_anti")
                     .select(F.lit("order_without_customer").alias("rule"), F.col("o_orderkey").alias("key_a"),
                             F.col("o_custkey").alias("key_b"), F.lit(1).cast("bigint").alias("n")))
    early = (lineitem.groupBy("l_orderkey", "l_linenumber", "l_shipdate").agg(F.count(F.lit(1)).alias("_n"))
             .join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
             .where(F.col("l_shipdate") < F.col("o_orderdate"))
             .groupBy("l_orderkey", "l_linenumber").agg(F.sum("_n").alias("n"))
             .select(F.lit("shipped_before_order").alias("rule"), F.col("l_orderkey").alias("key_a"),
                     F.col("l_linenumber").cast("bigint").alias("key_b"), "n"))
    return dup.unionByName(orphan_lines).unionByName(orphan_orders).unionByName(early)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents whose text is equal after lower-casing and whitespace
    folding. One row per document in a group of two or more: doc_id,
    keep_id (lowest id of the group), copies (group size).

    Only a 32-character key leaves each row, written once: texts are read
    and hashed once, whole. Groups are formed by an aggregate (partial per
    map task, so a text copied a million times collapses early) and joined
    back on the key in a join that adaptive execution can split
    (`skew_join`).
    """
    keyed = materialize(docs.select(id_col, content_key(F.col(text_col)).alias("_key")))
    groups = (keyed.groupBy("_key").agg(F.min(id_col).alias("keep_id"),
                                        F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1))
    return skew_join(keyed, groups, ["_key"]).select(id_col, "keep_id", "copies")


def json_field(df: DataFrame, id_col: str, json_col: str, schema: str) -> DataFrame:
    """Typed fields parsed from JSON text with a declared schema (no
    inference pass); fields are expanded to top-level columns."""
    parsed = F.from_json(F.col(json_col), schema)
    return df.select(id_col, parsed.alias("_j")).select(id_col, "_j.*")


def daily_pivot(events: DataFrame, ts: str, category: str, values: Sequence[str],
                other: str = "other") -> DataFrame:
    """Rows per day and category, one column per listed category, zero for
    missing combinations; unlisted and null categories are counted in
    ``other``. Listing the values avoids a distinct-values job."""
    columns = [*values, other]
    listed = F.when(F.col(category).isin(list(values)), F.col(category)).otherwise(F.lit(other))
    return (events.select(F.to_date(F.col(ts)).alias("day"), listed.alias("_c"))
            .groupBy("day").pivot("_c", columns).agg(F.count(F.lit(1)))
            .fillna(0, subset=columns))


def hash_split(df: DataFrame, id_col: str, buckets: int = 10, train_below: int = 8) -> DataFrame:
    """Reproducible train/test split: fold = md5-bucket of the id; train when
    fold < train_below. No shuffle and no dependence on partitioning."""
    fold = hash_bucket(F.col(id_col), buckets)
    return df.select(id_col, fold.alias("fold"),
                     F.when(fold < train_below, F.lit("train")).otherwise(F.lit("test")).alias("split"))


def standard_scores(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    digits: int = 6) -> DataFrame:
    """(x - mean) / sample sd for each column.

    The statistics are one aggregate row (partial aggregation, no skew
    issue); that single row is fetched and inlined as literals, so the
    scoring pass is a plain projection inside whole-stage codegen.
    """
    aggs = []
    for c in columns:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}")]
    stats = df.agg(*aggs).first()
    out = [F.col(k) for k in keys]
    for c in columns:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        z = safe_div(F.col(c).cast("double") - F.lit(m), F.lit(s)) if m is not None else F.lit(None).cast("double")
        out.append(F.round(z, digits).alias(f"z_{c}"))
    return df.select(*out)


def out_of_fold_target_mean(rows: DataFrame, id_col: str, group: str, target: str,
                            folds: int = 5, digits: int = 6) -> DataFrame:
    """Target encoding without leakage: for each row, the mean of ``target``
    over rows of the same ``group`` in the other folds (fold = id mod
    ``folds``). Built from sums per (group, fold) -- an aggregate, one row
    per pair -- minus the row's own fold, joined back (written once and
    broadcast when its size check passes); nothing is windowed over a whole
    group."""
    fold = F.pmod(F.col(id_col), F.lit(folds)).cast("int")
    keyed = rows.select(id_col, group, fold.alias("fold"), F.col(target).cast("double").alias("_y"))
    per_fold = keyed.groupBy(group, "fold").agg(F.sum("_y").alias("_s"), F.count("_y").alias("_c"))
    per_group = per_fold.groupBy(group).agg(F.sum("_s").alias("_s_all"), F.sum("_c").alias("_c_all"))
    enc = (join_on_keys(per_fold, per_group, [group])
           .select(group, "fold",
                   F.round(safe_div(F.col("_s_all") - F.col("_s"), F.col("_c_all") - F.col("_c")), digits)
                   .alias("target_mean")))
    return join_on_keys(keyed, broadcast_per_group(enc), [group, "fold"]).select(
        id_col, group, "fold", "target_mean")
