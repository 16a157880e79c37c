"""Text and vectors: TF-IDF weights, nearest vectors to class centroids,
near-duplicate documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import stable_round
from ..functions.text import token_rows, tokens
from ..functions.vectors import as_double, dot, norm
from ..plans.broadcast import bounded_broadcast, row_count_at_most
from ..plans.keys import skew_join
from ..plans.lineage import in_place, materialize
from ..plans.ranking import global_row_index
from ..plans.spread import spread_by


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: str = "lang",
          digits: int = 6) -> DataFrame:
    """Term frequency, document frequency and weight tf * ln((1+N)/(1+df))
    per (document, token), where df and N are counted within the document's
    ``group`` (language). Tokens: whole text, lower-cased, split on
    whitespace.

    tf is an aggregate per (doc, token); df an aggregate of those per
    (group, token), so a token found in every document is counted from one
    row per document and partial sums. The df table is joined back on
    (group, token) in a join that adaptive execution can split for very
    common tokens (`skew_join`), and N (one row per group, size-checked) is
    broadcast.
    Texts are spread over the cores by document id when the scan has too
    few tasks (`spread_by`); tf then groups on that partitioning.
    """
    toks = token_rows(spread_by(docs.select(id_col, group, text_col), id_col), [id_col, group], text_col)
    tf = toks.groupBy(id_col, group, "token").agg(F.count(F.lit(1)).alias("tf"))
    # df counts the documents whose tf is positive. Reading tf keeps tf's
    # own aggregate in this branch, so both uses of tf share one exchange
    # and the texts are tokenised once; a row count would let the optimizer
    # prune it into a separate distinct over the tokens (a second pass).
    df_ = tf.groupBy(group, "token").agg(F.count_if(F.col("tf") > 0).alias("df"))
    n_docs = bounded_broadcast(docs.groupBy(group).agg(F.count(F.lit(1)).alias("_N")), 10_000)
    w = F.col("tf") * F.log((F.lit(1) + F.col("_N")) / (F.lit(1) + F.col("df")))
    return (skew_join(tf, df_, [group, "token"]).join(n_docs, group)
            .select(id_col, group, "token", "tf", "df", stable_round(w, digits).alias("weight")))


# Query vectors inlined into one scoring pass; more are scored in batches.
MAX_QUERY_VECTORS = 1_000


def nearest_to_centroids(emb: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                         label: str = "label", digits: int = 6,
                         max_per_pass: int = MAX_QUERY_VECTORS) -> DataFrame:
    """For each label, the ``k`` vectors with the highest cosine similarity
    to the label's centroid (mean vector). Score rounded to ``digits``;
    ties by id.

    Centroids are an aggregate per (label, dimension), one row per label and
    dimension. Up to ``max_per_pass`` of them (checked) are fetched and
    written into the plan as one array literal, so scoring needs no join at
    all: every vector computes its dot product with each centroid
    (`aggregate` over `zip_with`, in generated code). A first pass takes the
    best score of each label in each of ``buckets`` hash buckets of the
    vectors; the k-th largest of them is a floor that the k best vectors
    reach, so the second pass ranks only the few vectors at or above it.

    With more labels than that, labels are numbered (`global_row_index`)
    and cut into batches of ``max_per_pass``; each batch is one such pass,
    and its top-k (final, as each label is in one batch) is written to the
    checkpoint folder. The driver holds one batch of centroids at a time.
    """
    parts = emb.select(label, F.posexplode(as_double(F.col(vec_col))).alias("_d", "_x"))
    cent = materialize(parts.groupBy(label, "_d").agg(F.avg("_x").alias("_m"))
                       .groupBy(label).agg(F.sort_array(F.collect_list(F.struct("_d", "_m"))).alias("_c")))
    if row_count_at_most(cent, max_per_pass):
        # bounded: at most max_per_pass rows, checked above
        return _top_k_to(emb, cent.collect(), k, id_col, vec_col, label, digits)
    numbered = materialize(global_row_index(cent, [label], "_i")
                           .withColumn("_batch", F.floor(F.col("_i") / max_per_pass)))
    batches = numbered.agg(F.max("_batch")).first()[0] + 1
    done = [materialize(_top_k_to(emb, numbered.where(F.col("_batch") == b).collect(),
                                  k, id_col, vec_col, label, digits))
            for b in range(batches)]
    return reduce(DataFrame.unionByName, done)


def _top_k_to(emb: DataFrame, rows: list, k: int, id_col: str, vec_col: str, label: str,
              digits: int, buckets: int = 256) -> DataFrame:
    """Top ``k`` vectors by cosine to each centroid row (label, _c)."""
    labels = [r[label] for r in rows]
    vectors = [[float(e["_m"]) for e in r["_c"]] for r in rows]
    norms = [sum(x * x for x in v) ** 0.5 for v in vectors]
    # Typed literals: an empty list (no labels) would otherwise be array<void>.
    label_type = emb.schema[label].dataType.simpleString()
    qs = F.lit(vectors).cast("array<array<double>>")
    v = as_double(F.col(vec_col))
    sims = F.transform(qs, lambda q: dot(q, v))
    scored = emb.select(id_col, norm(v).alias("_vn"),
                        F.posexplode(sims).alias("_q", "_dot"))
    score = F.col("_dot") / (F.col("_vn") * F.element_at(F.lit(norms).cast("array<double>"), F.col("_q") + 1))
    scored = scored.select("_q", F.element_at(F.lit(labels).cast(f"array<{label_type}>"), F.col("_q") + 1)
                           .alias("query_label"), id_col,
                           stable_round(score, digits).alias("score"))
    bucket = F.pmod(F.xxhash64(id_col), F.lit(max(buckets, 2 * k)))
    best = scored.groupBy("_q", bucket.alias("_b")).agg(F.max("score").alias("_m"))
    kth = best.groupBy("_q").agg(F.try_element_at(F.sort_array(F.collect_list("_m"), asc=False), F.lit(k)).alias("f"))
    found = {r["_q"]: r["f"] for r in kth.collect()}  # one row per label of this batch
    floors = F.lit([found.get(i) if found.get(i) is not None else float("-inf") for i in range(len(labels))])
    scored = scored.where(F.col("score") >= F.element_at(floors.cast("array<double>"), F.col("_q") + 1)).drop("_q")
    w = Window.partitionBy("query_label").orderBy(F.col("score").desc(), F.col(id_col))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def shingle_rows(docs: DataFrame, id_col: str, text_col: str, n: int = 3, distinct: bool = True) -> DataFrame:
    """(id, shingle) rows, distinct unless ``distinct=False``: word n-grams
    of the whole lower-cased text; a text with fewer than n tokens is one
    shingle.

    The n-grams come from `arrays_zip` of the token array with itself
    shifted by 1 .. n-1 positions, exploded: each output row holds only its
    n words. (Exploding positions while carrying the token array would copy
    the whole array into every row -- quadratic in text length -- and an
    n-gram lambda over the array is re-tokenised per position once the
    optimizer inlines the tokens.)
    """
    toks = docs.select(id_col, tokens(F.col(text_col)).alias("_tok"))
    zipped = F.arrays_zip(*[F.slice("_tok", j + 1, F.size("_tok")).alias(f"_w{j}") for j in range(n)])
    rows = toks.select(id_col, F.size("_tok").alias("_len"), F.posexplode(zipped).alias("_p", "_z"))
    keep = (F.col("_p") <= F.col("_len") - n) | ((F.col("_len") < n) & (F.col("_p") == 0))
    gram = F.concat_ws(" ", *[F.col("_z").getField(f"_w{j}") for j in range(n)])
    out = rows.where(keep).select(id_col, gram.alias("_g"))
    return out.distinct() if distinct else out


# Two fifths of the grams are enough to choose a fifth of rare ones from.
_POOL = 2, 5


def _short(h: Column) -> Column:
    """40 bits of a 64-bit hash."""
    return F.shiftrightunsigned(h, 24)


def _in_pool(h: Column) -> Column:
    return h % _POOL[1] < _POOL[0]


def _by_id(df: DataFrame, key: str) -> DataFrame:
    """``df`` hash-partitioned on ``key``, into no fewer partitions than it
    has, the cluster has cores and shuffles have: rows travel as they are and
    later joins on ``key`` find them in place."""
    spark = df.sparkSession
    parts = max(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, key)


def _smallest_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """For every ``_b`` of the candidate ``pairs`` (_b, _a) the smallest _a
    whose set has the similarity: columns _rep, dup_of, jaccard.

    A set is compared with its candidates in ascending order, one at first and
    eight times as many in each further round, until one is similar or none is
    left: in a large group of near-copies few pairs meet whole. ``sets`` lie by
    ``_rep``; those of a round's pairs are sent, no others."""
    left = materialize(pairs.withColumn("_p", F.row_number().over(Window.partitionBy("_b").orderBy("_a"))))
    found, upto = [], 1
    while not found or not left.isEmpty():
        now = left.where(F.col("_p") <= upto)
        ids = now.select(F.explode(F.array("_a", "_b")).alias("_rep")).distinct()
        whole = materialize(sets.join(ids, "_rep", "left_semi"))
        x = whole.select(F.col("_rep").alias("_a"), F.col("_set").alias("_x"))
        y = whole.select(F.col("_rep").alias("_b"), F.col("_set").alias("_y"))
        both = F.size(F.array_intersect("_x", "_y")).cast("long")
        links = (now.join(x, "_a").join(y, "_b")
                 .select("_a", "_b", both.alias("_i"), (F.size("_x") + F.size("_y") - both).alias("_u"))
                 .where(den * F.col("_i") >= num * F.col("_u")))
        link = F.min(F.struct(F.col("_a").alias("dup_of"), (F.col("_i") / F.col("_u")).alias("jaccard")))
        found.append(materialize(links.groupBy(F.col("_b").alias("_rep")).agg(link.alias("_m")).select("_rep", "_m.*")))
        left = materialize(left.where(F.col("_p") > upto)
                           .join(found[-1].select(F.col("_rep").alias("_b")), "_b", "left_anti"))
        upto *= 8
    return reduce(DataFrame.unionByName, found)


def near_duplicates(docs: DataFrame, num: int = 8, den: int = 10, id_col: str = "doc_id",
                    text_col: str = "text", digits: int = 6) -> DataFrame:
    """Near-duplicate documents: Jaccard similarity of the word 3-gram sets
    of at least ``num / den``, found exactly. Output: doc_id, dup_of,
    jaccard, where dup_of is the smallest id doc_id is a near-duplicate of;
    documents without a smaller one do not appear.

    Equal sets are one row named by their smallest document. Grams are ordered
    by a rule that looks at the gram only, and a set of n grams keeps its first
    n - ceil(num / den * n) + 1: two near-duplicates share one of these. Sets
    that share one and whose sizes allow the similarity are compared whole,
    each pair once.

    The order puts grams of a fixed part of the hash space (`_POOL`) first and
    there the rarest (ties by hash), so a set has only its grams of that part
    counted, or all of them if the part holds too few to choose from. Such a
    set's other grams come last, by their count among sets of its kind. A gram
    counted once pairs nothing.

    Sets are compared as 64-bit hashes; to count and pair grams, 40 bits do, as
    a collision only makes one more pair to compare. Texts travel once, by id;
    whole sets only if they are in a pair. Both inputs of the joins on grams
    come out of a shuffle, so that adaptive execution splits a gram that very
    many sets keep.
    """
    docs = _by_id(docs.select(id_col, text_col), id_col)
    grams = shingle_rows(docs, id_col, text_col, distinct=False)
    sets = (grams.select(id_col, F.xxhash64("_g").alias("_h")).groupBy(id_col)
            .agg(F.sort_array(F.collect_set("_h")).alias("_set")))
    with in_place(docs.sparkSession):
        sets = materialize(sets.withColumn("_key", F.md5(F.array_join("_set", ",").cast("binary"))))
    first = materialize(sets.groupBy("_key").agg(F.min(id_col).alias("_rep")))
    # Sets lie by id already, so only the names of the first ones travel here.
    reps = (sets.select(F.col(id_col).alias("_rep"), "_set").join(first.select("_rep"), "_rep", "left_semi")
            .withColumn("_n", F.size("_set")).withColumn("_keep", F.col("_n") - F.ceil(num * F.col("_n") / den) + 1))
    pool = F.filter("_set", lambda h: _in_pool(_short(h)))
    reps = reps.withColumn("_in", F.size(pool))
    enough = 2 * F.col("_in") >= 3 * F.col("_keep")
    rows = reps.select("_rep", F.explode(F.when(enough, pool).otherwise(F.col("_set"))).alias("_h")).select(
        "_rep", _short(F.col("_h")).alias("_h"))
    df_ = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    # Count and gram as one number, which sorts by both.
    shared = (skew_join(rows, df_, ["_h"])
              .select("_rep", F.shiftleft(F.least("_df", F.lit((1 << 23) - 1)), 40).bitwiseOR(F.col("_h")).alias("_g"))
              .join(reps.select("_rep", "_n", "_in", "_keep"), "_rep")
              .withColumn("_h", F.col("_g").bitwiseAND((1 << 40) - 1)))
    # Places of the grams of a part: those counted once, then the shared ones.
    inside = _in_pool(F.col("_h"))
    part = Window.partitionBy("_rep", inside)
    place = (F.row_number().over(part.orderBy("_g")) - F.count(F.lit(1)).over(part)
             + F.when(inside, F.col("_in")).otherwise(F.col("_n")))
    kept = materialize(shared.withColumn("_r", place).where(F.col("_r") <= F.col("_keep")).select("_rep", "_n", "_h"))
    other = kept.select(F.col("_rep").alias("_a"), F.col("_n").alias("_m"), "_h")
    pairs = (kept.join(other, "_h")
             .where((F.col("_rep") > F.col("_a")) &
                    (den * F.least("_n", "_m") >= num * F.greatest("_n", "_m")))
             .select(F.col("_rep").alias("_b"), "_a").distinct())
    best = _smallest_links(pairs, reps.select("_rep", "_set"), num, den)
    named = materialize(first.join(best, "_rep", "left").select(
        "_key", F.coalesce("dup_of", "_rep").alias("dup_of"), F.coalesce("jaccard", F.lit(1.0)).alias("jaccard")))
    return (sets.select(id_col, "_key").join(named, "_key").where(F.col("dup_of") < F.col(id_col))
            .select(id_col, "dup_of", stable_round(F.col("jaccard"), digits).alias("jaccard")))
