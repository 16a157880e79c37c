"""Bootstrap intervals in one pass over the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div, stable_round

# The draws are numbers below this prime, so that a square fits in a long.
PRIME = (1 << 31) - 1
# Fixed odd multipliers of the rounds of `draw`.
ROUNDS = (1103515245, 1664525193, 1597334677)
MICRO = 1_000_000


def poisson_bounds(most: int = 8) -> list[int]:
    """From which draw on a Poisson(1) weight is at least 1, 2, ... ``most``."""
    below = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(most)]
    return [int(PRIME * p) for p in below]


def draw(rows: DataFrame, key: str, replicate: str, name: str = "x") -> DataFrame:
    """``rows`` with a number in [0, PRIME) that depends on the longs key and
    replicate alone: rounds of a multiplication and a square, each modulo
    PRIME, in arithmetic that every engine has. Every step is a projection of
    its own: it uses the one before it twice, and as one expression the
    steps would double each other."""
    k, r, x, prime = F.col(key), F.col(replicate), F.col(name), F.lit(PRIME)
    high = F.floor(k / prime).cast("long")
    rows = rows.withColumn(name, F.pmod(F.pmod(k, prime) * F.lit(ROUNDS[0]) + r * F.lit(40_692) + F.pmod(high, prime), prime))
    for i, m in enumerate(ROUNDS):
        rows = rows.withColumn(name, F.pmod(x * x + r * F.lit(69_621 + i) + F.lit(m), prime))
        rows = rows.withColumn(name, F.pmod(x * F.lit(m) + F.pmod(k, prime), prime))
    return rows


def bootstrap_means(rows: DataFrame, group: str, value: str, key: str, replicates: int = 200,
                    confidence: float = 0.95, digits: int = 6, key_repeats: bool = True) -> DataFrame:
    """Mean and percentile interval of ``value`` per group: group, ``n``,
    ``mean``, ``low``, ``high``, ``replicates`` (how many had any weight).

    Poisson bootstrap: a replicate gives each key a Poisson(1) weight drawn
    from a hash of (key, replicate), so no row is moved or kept to be drawn
    again, and every run, partitioning and retried task draws the same. All
    rows of a key are drawn together: with a row id rows are resampled, with
    a user's id users are. Where keys repeat, their rows are added up first
    and weights are drawn once per key; ``key_repeats=False`` saves that
    shuffle for row ids, with the same result. What is shuffled then is three
    sums per task, group and replicate.

    Sums are exact: whole parts and millionths are added up as longs (values
    below 2^53), so results do not depend on the order of the rows.

    Defined cases: rows whose value is null or not finite, or whose key is
    null, are left out; a null group is a group like any other; a group of
    one key has its mean as both bounds; an empty table gives no rows.
    """
    v = F.col(value).cast("double")
    whole = F.floor(v).cast("long")
    rows = (rows.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(1 << 53)) & F.col(key).isNotNull())
            .select(F.col(group).alias("g"), F.col(key).cast("long").alias("k"), whole.alias("a"),
                    F.floor((v - whole) * MICRO + 0.5).cast("long").alias("b"), F.lit(1).cast("long").alias("n")))
    if key_repeats:
        rows = rows.groupBy("g", "k").agg(*[F.sum(c).alias(c) for c in "abn"])
    # Replicate 0 is the data itself.
    drawn = rows.select("g", "k", "a", "b", "n",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicates).cast("long"))).alias("r"))
    drawn = draw(drawn, "k", "r")
    more = [(F.col("x") >= F.lit(t)).cast("long") for t in poisson_bounds()]
    w = F.when(F.col("r") == 0, F.lit(1).cast("long")).otherwise(sum(more[1:], more[0]))
    # Weights of 0 are added too: a filter on them would compute them twice.
    sums = drawn.withColumn("w", w).groupBy("g", "r").agg(
        *[F.sum(F.col("w") * F.col(c)).alias(c) for c in "abn"])
    mean = safe_div(F.col("a") + F.col("b") / F.lit(float(MICRO)), F.col("n"))
    # At most one mean per replicate is gathered.
    found = sums.withColumn("m", mean).groupBy("g").agg(
        F.max(F.when(F.col("r") == 0, F.col("n"))).alias("n"), F.max(F.when(F.col("r") == 0, F.col("m"))).alias("mean"),
        F.sort_array(F.collect_list(F.when(F.col("r") > 0, F.col("m")))).alias("ms"))
    size, tail = F.size("ms"), (1 - confidence) / 2
    at = lambda share: F.try_element_at("ms", (F.floor((size - 1) * F.lit(share) + 0.5) + 1).cast("int"))
    return found.select(F.col("g").alias(group), "n", stable_round(F.col("mean"), digits).alias("mean"),
                        stable_round(at(tail), digits).alias("low"), stable_round(at(1 - tail), digits).alias("high"),
                        size.alias("replicates"))
