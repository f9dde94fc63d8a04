"""Frequent skill sets and association rules.

transactions (one array per resume, cleaned in place: no shuffle)
  -> effective support (one aggregate action)
  -> FP-growth (distributed, Spark ML)
  -> rules with any split of an itemset into antecedent and consequent.

Every subset of a frequent itemset is itself frequent, so enumerating the
non-empty proper subsets of each itemset and joining back to the itemsets is
complete and its size is bounded by the itemset table itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvlens.functions.predicates import is_noise_skill
from cvlens.functions.text import strip_ws
from cvlens.session import stored

KEY_SEP = "\u0001"


def _check_threshold(name: str, value: float) -> None:
    if not 0 < value <= 1:
        raise ValueError(f"{name} is a share above 0 and at most 1")


_TAG = "struct<k:string,idx:int,w:string>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_spelling(items: Column) -> Column:
    """Case-insensitive de-duplication keeping the first spelling, in order.

    Sort (lower, position) tags, keep each tag whose predecessor has another
    key, then restore the original order: O(n log n) per array, row-local.
    """
    tagged = F.transform(items, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("idx"), x.alias("w")))

    def firsts(srt: Column) -> Column:
        prev = F.concat(F.array(F.lit(None).cast(_TAG)), F.slice(srt, 1, F.greatest(F.size(srt) - 1, F.lit(0))))
        return F.filter(
            F.zip_with(srt, prev, lambda c, p: F.when(c.isNotNull() & (p.isNull() | (p["k"] != c["k"])),
                                                       F.struct(c["idx"].alias("idx"), c["w"].alias("w")))),
            lambda x: x.isNotNull())

    return F.transform(F.array_sort(_let(F.array_sort(tagged), firsts)), lambda x: x["w"])


def clean_transaction(items: Column) -> Column:
    """Drop nulls and noise, strip, and keep the first spelling per lower case.

    Noise is a matter of the lower-cased item, so it is tested once per kept
    spelling.
    """
    stripped = F.array_distinct(F.transform(F.filter(items, lambda s: s.isNotNull()), strip_ws))
    return F.filter(first_spelling(stripped), lambda s: ~is_noise_skill(s, stripped=True))


def transactions(resumes: DataFrame, skills_col: str = "normalized_skills",
                 id_col: str = "resume_id", clean: bool = True) -> DataFrame:
    """(id, items) for every resume whose cleaned skill list is non-empty; row by row, without a shuffle."""
    items = F.coalesce(F.col(skills_col), F.array().cast("array<string>"))
    items = clean_transaction(items) if clean else F.array_distinct(items)
    # a filter on the list would be pushed below it and clean every list twice
    kept = F.explode_outer(F.filter(F.array(items), lambda x: F.size(x) > 0))
    return resumes.select(F.col(id_col).alias("resume_id"), kept.alias("items")).where(F.col("items").isNotNull())


def effective_min_support(min_support: float, n_transactions: int) -> float:
    """Raise the support floor so that an itemset needs at least two baskets."""
    if n_transactions <= 0:
        raise ValueError("support of no transactions is undefined")
    return max(min_support, min(1.0, 2.0 / n_transactions))


@dataclass
class MiningResult:
    itemsets: DataFrame      # items array<string> (sorted), freq bigint, support double
    rules: DataFrame         # antecedents, consequents (sorted arrays), support, confidence, lift
    n_transactions: int
    effective_support: float


def frequent_itemsets(tx: DataFrame, min_support: float, n: int | None = None,
                      num_partitions: int | None = None) -> tuple[DataFrame, int, float]:
    """FP-growth over ``tx.items``; returns (itemsets, n, effective support)."""
    _check_threshold("min_support", min_support)
    if n is None:
        n = tx.count()
    eff = effective_min_support(min_support, n)
    # FP-growth turns the threshold into ceil(support * n) and floating error
    # can push that one too high; ask for slightly less, filter exactly after.
    fp = FPGrowth(itemsCol="items", minSupport=max(eff - 1e-9, 0.0), minConfidence=1.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    sets = fp.fit(tx.select("items")).freqItemsets
    sets = (sets.select(F.array_sort("items").alias("items"), F.col("freq").cast("long").alias("freq"))
            .withColumn("support", F.col("freq") / F.lit(float(n)))
            .where(F.col("support") >= F.lit(eff)))
    return sets, n, eff


def association_rules(itemsets: DataFrame, n: int, min_confidence: float) -> DataFrame:
    """All antecedent => consequent splits of every itemset of size >= 2."""
    _check_threshold("min_confidence", min_confidence)
    keyed = itemsets.select(F.array_join("items", KEY_SEP).alias("key"), "items", "freq")
    multi = keyed.where(F.size("items") >= 2)
    # bit mask b in 1 .. 2^m - 2 picks the antecedent; its complement is the consequent
    masks = multi.select(
        "items", F.col("freq").alias("freq_ac"),
        F.explode(F.sequence(F.lit(1).cast("long"),
                             F.pow(F.lit(2), F.size("items")).cast("long") - 2)).alias("mask"))

    def pick(bit_set: bool) -> Column:
        return F.filter("items", lambda x, i: (F.bit_get(F.col("mask"), i) == 1) == F.lit(bit_set))

    splits = masks.select("freq_ac", pick(True).alias("antecedents"), pick(False).alias("consequents"))
    ant = keyed.select(F.col("key").alias("a_key"), F.col("freq").alias("freq_a"))
    con = keyed.select(F.col("key").alias("c_key"), F.col("freq").alias("freq_c"))
    nn = F.lit(float(n))
    rules = (splits
             .withColumn("a_key", F.array_join("antecedents", KEY_SEP))
             .withColumn("c_key", F.array_join("consequents", KEY_SEP))
             .join(ant, "a_key").join(con, "c_key")
             .select("antecedents", "consequents",
                     (F.col("freq_ac") / nn).alias("support"),
                     ((F.col("freq_ac") / nn) / (F.col("freq_a") / nn)).alias("confidence"),
                     (F.col("freq_c") / nn).alias("consequent_support")))
    return (rules.withColumn("lift", F.col("confidence") / F.col("consequent_support"))
            .where(F.col("confidence") >= F.lit(min_confidence))
            .select("antecedents", "consequents", "support", "confidence", "lift"))


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """Highest lift first; ties broken by antecedent then consequent."""
    return (rules.withColumn("_a", F.array_join("antecedents", KEY_SEP))
            .withColumn("_c", F.array_join("consequents", KEY_SEP))
            .orderBy(F.desc("lift"), "_a", "_c").limit(n).drop("_a", "_c"))


def mine_associations(resumes: DataFrame, min_support: float = 0.1, min_confidence: float = 0.5,
                      skills_col: str = "normalized_skills", id_col: str = "resume_id",
                      clean: bool = True, num_partitions: int | None = None) -> MiningResult:
    """End-to-end mining over resumes' normalised skills."""
    _check_threshold("min_support", min_support)
    _check_threshold("min_confidence", min_confidence)
    tx = transactions(resumes, skills_col, id_col, clean).persist(StorageLevel.MEMORY_AND_DISK)
    n = tx.count()
    if n == 0:
        tx.unpersist()
        if resumes.isEmpty():
            raise ValueError("no resumes to mine")
        raise ValueError("no resume has a skill left after cleaning")
    sets, n, eff = frequent_itemsets(tx, min_support, n, num_partitions)
    sets = stored(sets, "itemsets")
    tx.unpersist()
    rules = association_rules(sets, n, min_confidence)
    return MiningResult(sets, rules, n, eff)
