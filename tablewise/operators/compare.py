"""Comparing two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# JSON keeps milliseconds only unless told otherwise.
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def keyed_difference(old: DataFrame, new: DataFrame, keys: list[str], values: list[str],
                     unchanged: bool = False) -> DataFrame:
    """What changed per key between two versions of a table: the key columns,
    ``status`` (added, removed, changed; unchanged only if asked for),
    ``rows_old`` and ``rows_new``, ``rows_added`` and ``rows_removed`` (as
    multisets: a row held twice and then once is removed once), and
    ``duplicates_old`` and ``duplicates_new`` (rows beyond the first of equal
    ones).

    The versions are put one after the other, not joined: a row shrinks to its
    keys and a SHA-256 of its values, equal rows are counted in the task before
    the shuffle, and a key's counts are added up task by task again. So no key
    is ever gathered in one place, however many rows it holds.

    Defined cases: null keys are keys like any other and equal to each
    other, null values too; values are compared by
    their JSON text (microseconds kept; -0.0 is not 0.0); columns not named
    are left out; an empty version makes every key added or removed, two of
    them give no rows.
    """
    def side(df: DataFrame, in_new: int) -> DataFrame:
        text = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values)]), JSON)
        return df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                         F.unhex(F.sha2(text, 256)).alias("h"), F.lit(in_new).alias("in_new"))
    names = [f"k{i}" for i in range(len(keys))]
    rows = (side(old, 0).unionByName(side(new, 1)).groupBy(*names, "h")
            .agg(F.sum(1 - F.col("in_new")).alias("o"), F.sum("in_new").alias("n")))
    more = lambda a, b: F.sum(F.greatest(F.col(a) - b, F.lit(0)))
    out = rows.groupBy(*names).agg(
        F.sum("o").alias("rows_old"), F.sum("n").alias("rows_new"),
        more("n", F.col("o")).alias("rows_added"), more("o", F.col("n")).alias("rows_removed"),
        more("o", F.lit(1)).alias("duplicates_old"), more("n", F.lit(1)).alias("duplicates_new"))
    status = (F.when(F.col("rows_old") == 0, "added").when(F.col("rows_new") == 0, "removed")
              .when(F.col("rows_added") + F.col("rows_removed") > 0, "changed").otherwise("unchanged"))
    out = out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], status.alias("status"), "rows_old", "rows_new",
                     "rows_added", "rows_removed", "duplicates_old", "duplicates_new")
    return out if unchanged else out.where(F.col("status") != "unchanged")
