"""Skill candidates and normalisation.

Candidates:

* explicit (P5): items of the SKILLS section split on ``, ; | newline``, row-local;
* implicit (P6): dictionary terms found in EXPERIENCE + PROJECTS text by an
  equi-join of the text's spans with the dictionary, which may be of any size
  (Spark broadcasts it or not by its size).

Both replace the reference's language-model tagging and therefore differ from
it by design; see README.

Normalisation (P8) works on **distinct** skill strings only:
exact alias on ``lower(strip(skill))`` (J1), else the best canonical name by
indel similarity >= cutoff (J2, ties -> smallest name), else ``lower(strip)``;
a blank skill becomes ''.

Fuzzy candidates: strings that reach the cutoff are at most d edits apart, with
d known from the two lengths. Of a name cut into d + 1 pieces, one is in the
skill unchanged, moved by no more places than insertions and deletions allow.
So an equi-join on (both lengths, piece number, piece) finds all candidates;
Levenshtein distance, never above the indel distance, prunes them on the JVM,
and only what is left is scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvlens.functions.fuzzy import admissible_lengths, edit_bound, indel_similarity
from cvlens.functions.text import strip_ws
from cvlens.session import stored

ITEM_SPLIT = r"[,;\n|]"


def explicit_skills(skills_section) -> Column:
    """List items of the skills section: stripped of bullets/colons, length > 1, distinct."""
    sec = F.col(skills_section) if isinstance(skills_section, str) else skills_section
    parts = F.split(F.coalesce(sec, F.lit("")), ITEM_SPLIT, -1)
    cands = F.transform(parts, lambda p: strip_ws(F.regexp_replace(
        F.regexp_replace(strip_ws(p), r"^[:\-. ]+", ""), r"[. ]+\z", "")))
    return F.array_distinct(F.filter(cands, lambda s: F.length(s) > 1))


ELEMENT = r"[A-Za-z0-9_]+|[^A-Za-z0-9_]"


def _elements(col) -> Column:
    """Runs of ASCII word characters, and every other character by itself."""
    return F.regexp_extract_all(col, F.lit(ELEMENT), 0)


# Hash values of a term's first element.
FIRSTS = 1 << 16


def _first_hash(col: Column) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(FIRSTS)).cast("int")


def dictionary_terms(aliases: DataFrame) -> DataFrame:
    """(term, n): the lower-cased, stripped, distinct alias keys and canonical names and their number of elements."""
    both = aliases.select(F.explode(F.array("alias", "canonical")).alias("t"))
    terms = both.select(F.lower(strip_ws("t")).alias("term")).where(F.col("term") != "").distinct()
    return stored(terms.withColumn("n", F.size(_elements(F.col("term")))), "terms")


def find_terms(texts: DataFrame, terms: DataFrame, row_col: str, text_col: str, out_col: str = "implicit_skills") -> DataFrame:
    """(row, out): the dictionary terms in each text (lower case), in order of their first occurrence.

    Texts are cut into elements; spans of as many elements as some term has are
    rows, and an equi-join with the dictionary keeps those that are terms. Spans
    begin and end where no word character is beside them. Of the hits of a row
    the leftmost counts, of those that begin together the longest, and what it
    covers is used up. Rows without a hit are not in the result. The driver
    only learns which numbers of elements there are, and which of ``FIRSTS`` hash
    values the terms' first elements have: spans are built only where one begins.
    """
    sizes = sorted(r["n"] for r in terms.select("n").distinct().collect())  # small numbers, as many as the longest term has
    firsts = [r["h"] for r in terms.select(_first_hash(F.element_at(_elements(F.col("term")), 1)).alias("h")).distinct().collect()]
    el = F.col("_el")
    may_begin = (lambda x: _first_hash(x).isin(firsts)) if len(firsts) <= FIRSTS // 4 else (lambda x: F.lit(True))
    word = lambda x: x.rlike(r"^\w")

    def spans(x: Column, i: Column) -> Column:
        begins = word(x) | (i == 0) | ~word(F.get(el, i - 1))
        every = []
        for n in sizes:
            parts = [x, *[F.get(el, i + k) for k in range(1, n)]]
            ends = word(parts[-1]) | F.coalesce(~word(F.get(el, i + n)), F.lit(True))
            every.append(F.struct(i.alias("at"), F.when(ends, F.concat(*parts)).alias("span")))
        return F.when(may_begin(x) & (x != " ") & begins, F.filter(F.array(*every), lambda c: c["span"].isNotNull()))

    if not sizes:
        return texts.select(row_col, F.array().cast("array<string>").alias(out_col)).limit(0)
    cut = texts.select(row_col, _elements(F.lower(F.coalesce(F.col(text_col), F.lit("")))).alias("_el"))
    rows = cut.select(row_col, F.inline(F.flatten(F.filter(F.transform("_el", spans), lambda s: s.isNotNull()))))
    hits = (rows.join(terms.withColumnRenamed("term", "span"), "span").groupBy(row_col)
            .agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "span"))).alias("_h")))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("found"))
    taken = F.aggregate("_h", start, lambda a, h: F.when(h["at"] >= a["free"], F.struct(
        (h["at"] - h["less"]).alias("free"), F.array_append(a["found"], h["span"]).alias("found"))).otherwise(a), lambda a: F.array_distinct(a["found"]))
    return hits.select(row_col, taken.alias(out_col))


def skill_set(explicit: Column, implicit: Column) -> Column:
    """``struct<explicit_skills, implicit_skills>`` plus all = concatenation (dups kept)."""
    return F.struct(explicit.alias("explicit_skills"), implicit.alias("implicit_skills"))


def exact_mapping(skills: DataFrame, aliases: DataFrame, skill_col: str = "skill") -> DataFrame:
    """(skill, exact) for every distinct stripped skill; exact is null without an alias."""
    uniq = (skills.select(strip_ws(F.col(skill_col)).alias("skill"))
            .where(F.col("skill").isNotNull() & (F.col("skill") != "")).distinct())
    # one canonical per alias key (a JSON object cannot repeat keys; be safe)
    alias = aliases.groupBy("alias").agg(F.min("canonical").alias("exact"))
    return uniq.join(alias, F.lower(uniq["skill"]) == alias["alias"], "left").drop("alias")


def fuzzy_candidates(skills: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """(skill, canonical) pairs that may reach ``cutoff``; every pair that does is among them."""
    la, lb, d = F.col("la"), F.col("lb"), F.col("d")
    start = F.floor(F.col("i") * lb / (d + 1)).cast("int")
    width = F.floor((F.col("i") + 1) * lb / (d + 1)).cast("int") - F.col("start")

    def pieces(df: DataFrame, own: str, other: str) -> DataFrame:
        return (df.withColumn(other, F.explode(admissible_lengths(F.col(own), cutoff)))
                .withColumn("d", edit_bound(la, lb, cutoff)).where(F.abs(la - lb) <= d)
                .withColumn("i", F.explode(F.sequence(F.lit(0), d)))
                .withColumn("start", start).withColumn("width", width))

    theirs = (pieces(names.withColumn("lb", F.length("canonical")), "lb", "la")
              .select("canonical", "la", "lb", "i", F.col("canonical").substr(F.col("start") + 1, F.col("width")).alias("piece")))
    deleted = F.floor((d - la + lb) / 2).cast("int")
    inserted = F.floor((d + la - lb) / 2).cast("int")
    ours = (pieces(skills.withColumn("la", F.length("skill")), "la", "lb")
            .withColumn("at", F.explode(F.sequence(F.col("start") - deleted, F.col("start") + inserted)))
            .where((F.col("at") >= 0) & (F.col("at") + F.col("width") <= la))
            .select("skill", "la", "lb", "i", F.col("skill").substr(F.col("at") + 1, F.col("width")).alias("piece")).distinct())
    pairs = ours.join(theirs, ["la", "lb", "i", "piece"]).select("skill", "canonical", "la", "lb").distinct()
    return (pairs.where(F.levenshtein("skill", "canonical") <= edit_bound(la, lb, cutoff))
            .select("skill", "canonical"))


def skill_mapping(skills: DataFrame, aliases: DataFrame, cutoff: float = 85.0,
                  skill_col: str = "skill") -> DataFrame:
    """(skill, normalized, method, score) for every distinct stripped skill."""
    exact = exact_mapping(skills, aliases, skill_col)
    unmatched = exact.where(F.col("exact").isNull()).select("skill")
    scored = (fuzzy_candidates(unmatched, aliases.select("canonical").distinct(), cutoff)
              .withColumn("sim", indel_similarity(F.col("skill"), F.col("canonical")))
              .where(F.col("sim") >= F.lit(cutoff / 100.0)))
    best = scored.groupBy("skill").agg(
        F.min_by(F.struct("canonical", "sim"), F.struct(-F.col("sim"), F.col("canonical"))).alias("b"))
    out = exact.join(best, "skill", "left")
    return out.select(
        "skill",
        F.coalesce("exact", F.col("b.canonical"), F.lower("skill")).alias("normalized"),
        F.when(F.col("exact").isNotNull(), "exact").when(F.col("b").isNotNull(), "fuzzy")
        .otherwise("fallback").alias("method"),
        F.when(F.col("exact").isNotNull(), F.lit(100.0)).otherwise(F.col("b.sim") * 100.0).alias("score"))


def normalize_skills(df: DataFrame, aliases: DataFrame, skills_col: str = "skills",
                     cutoff: float = 85.0, out_col: str = "normalized_skills") -> DataFrame:
    """Add ``out_col``: each row's normalised list, same order and length as ``skills_col``.

    Lists are taken apart once per distinct list and joined back by the list
    itself, so rows that share an id keep their own lists.
    """
    lists = df.select(F.col(skills_col).alias("_list")).where(F.size("_list") > 0).distinct()
    long = lists.select("_list", F.posexplode("_list").alias("pos", "raw")).withColumn("skill", strip_ws("raw"))
    mapping = skill_mapping(long, aliases, cutoff).select("skill", "normalized")
    done = (long.join(mapping, "skill", "left").select("_list", "pos", F.coalesce("normalized", F.lit("")).alias("n"))
            .groupBy("_list").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("_l"))
            .select("_list", F.transform("_l", lambda x: x["n"]).alias(out_col)))
    return (df.join(done, df[skills_col] == done["_list"], "left").drop("_list")
            .withColumn(out_col, F.coalesce(out_col, F.array().cast("array<string>"))))
