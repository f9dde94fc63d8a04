"""Registered queries: metrics (A5-A10, A13, A20, E5), validation (P20, P21, E2,
A11, A12, J3-J5, W3, W8) and scoring (E1, E3, E4, J6, J10, S9).

Truth and predictions come from the data: a document's language is its
label; predictions are stop-word votes over its words (raw text for one
source, cleaned text for the other, a shorter word list for the baseline).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cvlens.functions.text import WS_RUN, clean_text, clean_text_sql, split_words, strip_ws_sql
from cvlens.operators import metrics as M
from cvlens.operators import scoring as S
from cvlens.operators import validation as V
from cvlens.operators.mining import _let as let
from cvlens.plans.registry import r6, register
from cvlens.sources.tables import documents, order_baskets, order_baskets_sql, table

# Vote words per language (ours) and the order used to break ties.
VOTE_LANGS = ["en", "fr", "de", "es"]
VOTE_WORDS = {
    "en": ["the", "and", "of", "is", "to"],
    "fr": ["le", "la", "les", "des", "et", "du"],
    "de": ["der", "die", "und", "das", "ist"],
    "es": ["el", "los", "las", "del", "y", "que"],
}
SHORT_WORDS = {"en": ["the"], "fr": ["les"], "de": ["und"], "es": ["los"]}
FAIRNESS_CATEGORIES = ["de", "en", "es", "fr", "it"]
DISPLAY_NAMES = ["German", "English", "Spanish", "French"]


def vote(text, words=VOTE_WORDS):
    """The language whose words are most in ``text``; the text is split once, however often its counts are compared."""
    toks = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", -1)
    def member_of(ws):
        return lambda w: w.isin(ws)
    def likeliest(n):
        en, fr, de, es = (n[l] for l in VOTE_LANGS)
        return (F.when((en >= fr) & (en >= de) & (en >= es), "en")
                .when((fr >= de) & (fr >= es), "fr").when(de >= es, "de").otherwise("es"))
    return let(toks, lambda t: let(F.struct(*[F.size(F.filter(t, member_of(words[l]))).alias(l) for l in VOTE_LANGS]), likeliest))


def vote_sql(t, words=VOTE_WORDS):
    def n(l):
        ws = ", ".join(f"'{w}'" for w in words[l])
        return f"len(list_filter(string_split_regex(lower(coalesce({t}, '')), '[^a-z]+'), lambda w: w IN ({ws})))"
    en, fr, de, es = (n(l) for l in VOTE_LANGS)
    return (f"CASE WHEN {en} >= {fr} AND {en} >= {de} AND {en} >= {es} THEN 'en' "
            f"WHEN {fr} >= {de} AND {fr} >= {es} THEN 'fr' WHEN {de} >= {es} THEN 'de' ELSE 'es' END")


def predictions(spark, sf):
    d = documents(spark, sf)
    return d.select("doc_id", F.col("lang").alias("label"), vote(F.col("text")).alias("prediction"),
                    vote(F.col("text"), SHORT_WORDS).alias("baseline"),
                    vote(clean_text("text")).alias("pdf_prediction"))


PRED_SQL = f"""preds AS (SELECT doc_id, lang AS label, {vote_sql('text')} AS prediction,
  {vote_sql('text', SHORT_WORDS)} AS baseline, {vote_sql(clean_text_sql('text'))} AS pdf_prediction FROM documents)"""

CONF_SQL = f"""{PRED_SQL},
lab AS (SELECT label AS l FROM preds UNION SELECT prediction FROM preds),
f1s AS (SELECT l AS label,
          CAST(sum(CASE WHEN label = l AND prediction = l THEN 1 ELSE 0 END) AS BIGINT) AS tp,
          CAST(sum(CASE WHEN label <> l AND prediction = l THEN 1 ELSE 0 END) AS BIGINT) AS fp,
          CAST(sum(CASE WHEN label = l AND prediction <> l THEN 1 ELSE 0 END) AS BIGINT) AS fn
        FROM lab, preds GROUP BY l),
f1 AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM f1s)"""


def _macro_sql(label, pred):
    """accuracy and macro F1 of columns label/pred in CTE preds, as a subquery."""
    return f"""(SELECT a.accuracy, m.macro_f1 FROM
  (SELECT avg(CASE WHEN {label} = {pred} THEN 1.0 ELSE 0.0 END) AS accuracy FROM preds) a,
  (SELECT avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END) AS macro_f1 FROM (
     SELECT l, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
       SELECT {label} AS l, CASE WHEN {label} = {pred} THEN 1 ELSE 0 END AS tp, 0 AS fp,
              CASE WHEN {label} = {pred} THEN 0 ELSE 1 END AS fn FROM preds
       UNION ALL SELECT {pred}, 0, CASE WHEN {label} = {pred} THEN 0 ELSE 1 END, 0 FROM preds) GROUP BY l)) m)"""


@register("accuracy", f"""WITH {PRED_SQL}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM preds""")
def q_accuracy(spark, sf):
    s = M.classification_summary(predictions(spark, sf))
    return s.select(F.col("n").cast("long"), r6("accuracy").alias("accuracy"))


@register("per_class_f1", f"""WITH {CONF_SQL}
SELECT label, tp, fp, fn, round(f1, 6) AS f1 FROM f1""")
def q_per_class_f1(spark, sf):
    f = M.per_class_f1(predictions(spark, sf))
    return f.select("label", "tp", "fp", "fn", r6("f1").alias("f1"))


@register("macro_f1", f"""WITH {CONF_SQL}
SELECT round(avg(f1), 6) AS macro_f1, CAST(count(*) AS BIGINT) AS n_labels FROM f1""")
def q_macro_f1(spark, sf):
    s = M.classification_summary(predictions(spark, sf))
    return s.select(r6("macro_f1").alias("macro_f1"), F.col("n_labels").cast("long"))


_names_values = ", ".join(f"('{n}', {i})" for i, n in enumerate(DISPLAY_NAMES))


@register("label_names", f"""WITH {CONF_SQL},
obs AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM f1),
nm AS (SELECT * FROM (VALUES {_names_values}) v(name, i))
SELECT nm.name, obs.label, round(f1.f1, 6) AS f1 FROM nm JOIN obs ON nm.i = obs.i JOIN f1 ON f1.label = obs.label""")
def q_label_names(spark, sf):
    out = M.resolve_label_names(predictions(spark, sf), DISPLAY_NAMES)
    return out.select("name", "label", r6("f1").alias("f1"))


_cats = ", ".join(f"('{c}')" for c in FAIRNESS_CATEGORIES)


@register("fairness", f"""WITH {CONF_SQL},
cf AS (SELECT c.category, coalesce(f1.f1, 0.0) AS f1 FROM (VALUES {_cats}) c(category)
       LEFT JOIN f1 ON f1.label = c.category),
sm AS (SELECT avg(f1) AS mean_f1, var_pop(f1) AS f1_variance, stddev_pop(f1) AS f1_std FROM cf)
SELECT category, round(f1, 6) AS f1, round(mean_f1, 6) AS mean_f1, round(f1_variance, 6) AS f1_variance,
  round(f1_std, 6) AS f1_std, round(mean_f1 - f1_std, 6) AS fairness_threshold, f1 < mean_f1 - f1_std AS flagged
FROM cf, sm""")
def q_fairness(spark, sf):
    f = M.fairness(predictions(spark, sf), FAIRNESS_CATEGORIES)
    return f.select("category", *[r6(c).alias(c) for c in ("f1", "mean_f1", "f1_variance", "f1_std",
                                                           "fairness_threshold")], "flagged")


@register("model_comparison", f"""WITH {PRED_SQL}
SELECT round(b.accuracy, 6) AS baseline_accuracy, round(b.macro_f1, 6) AS baseline_macro_f1,
  round(p.accuracy, 6) AS proposed_accuracy, round(p.macro_f1, 6) AS proposed_macro_f1,
  round(p.accuracy - b.accuracy, 6) AS accuracy_improvement, round(p.macro_f1 - b.macro_f1, 6) AS f1_improvement
FROM {_macro_sql('label', 'baseline')} b, {_macro_sql('label', 'prediction')} p""")
def q_model_comparison(spark, sf):
    p = predictions(spark, sf)
    c = M.compare_models(M.classification_summary(p, "label", "baseline"), M.classification_summary(p))
    return c.select(*[r6(x).alias(x) for x in c.columns])


@register("cross_source", f"""WITH {PRED_SQL}
SELECT round(c.accuracy, 6) AS csv_accuracy, round(c.macro_f1, 6) AS csv_macro_f1,
  round(p.accuracy, 6) AS pdf_accuracy, round(p.macro_f1, 6) AS pdf_macro_f1,
  round(abs(c.accuracy - p.accuracy), 6) AS accuracy_difference, round(abs(c.macro_f1 - p.macro_f1), 6) AS f1_difference,
  abs(c.accuracy - p.accuracy) <= 0.05 AND abs(c.macro_f1 - p.macro_f1) <= 0.05 AS consistent_performance
FROM {_macro_sql('label', 'prediction')} c, {_macro_sql('label', 'pdf_prediction')} p""")
def q_cross_source(spark, sf):
    p = predictions(spark, sf)
    both = (p.select("label", "prediction", F.lit("csv").alias("source"))
            .unionByName(p.select("label", F.col("pdf_prediction").alias("prediction"), F.lit("pdf").alias("source"))))
    c = M.cross_source_validation(both)
    return c.select(*[r6(x).alias(x) for x in c.columns if x != "consistent_performance"], "consistent_performance")


@register("binary_quality", """WITH
preds AS (SELECT CAST(quality AS VARCHAR) AS label, CAST(1 - toxic AS VARCHAR) AS prediction FROM labels),
lab AS (SELECT label AS l FROM preds UNION SELECT prediction FROM preds),
per AS (SELECT l, sum(CASE WHEN label = l AND prediction = l THEN 1 ELSE 0 END) AS tp,
          sum(CASE WHEN label <> l AND prediction = l THEN 1 ELSE 0 END) AS fp,
          sum(CASE WHEN label = l AND prediction <> l THEN 1 ELSE 0 END) AS fn FROM lab, preds GROUP BY l)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM preds) AS n,
  round((SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM preds), 6) AS accuracy,
  round(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END), 6) AS macro_f1
FROM per""")
def q_binary_quality(spark, sf):
    lab = table(spark, sf, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    s = M.classification_summary(lab)
    return s.select(F.col("n").cast("long"), r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))


# ---- validation: raw text vs its cleaned form / a lossy copy ---------------

def _words_sql(t):
    return (f"CASE WHEN {strip_ws_sql(t)} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({strip_ws_sql(t)}, '{WS_RUN}') END")


def _lensim_sql(a, b):
    la, lb = f"length(lower({strip_ws_sql(a)}))", f"length(lower({strip_ws_sql(b)}))"
    return (f"CASE WHEN {la} = 0 AND {lb} = 0 THEN 1.0 WHEN {la} = 0 OR {lb} = 0 THEN 0.0 "
            f"ELSE least({la}, {lb}) / greatest({la}, {lb}) END")


def _jacc_sql(a, b):
    sa, sb = f"list_distinct(list_transform({a}, lambda x: lower(x)))", f"list_distinct(list_transform({b}, lambda x: lower(x)))"
    i = f"len(list_intersect({sa}, {sb}))"
    return (f"CASE WHEN len({sa}) = 0 AND len({sb}) = 0 THEN 1.0 WHEN len({sa}) = 0 OR len({sb}) = 0 THEN 0.0 "
            f"ELSE {i} / (len({sa}) + len({sb}) - {i}) END")


def pairs(spark, sf):
    d = documents(spark, sf)
    c = clean_text("text")
    return d.select(F.col("doc_id").alias("resume_id"), F.col("text").alias("csv_text"), c.alias("pdf_text"),
                    split_words("text").alias("csv_skills"), split_words(c).alias("pdf_skills"))


PAIRS_SQL = f"""pairs AS (SELECT doc_id AS resume_id, text AS csv_text, c AS pdf_text,
  {_words_sql('text')} AS csv_skills, {_words_sql('c')} AS pdf_skills
  FROM (SELECT doc_id, text, {clean_text_sql('text')} AS c FROM documents))"""


@register("text_similarity", f"""WITH {PAIRS_SQL}
SELECT resume_id, round({_lensim_sql('csv_text', 'pdf_text')}, 6) AS text_similarity FROM pairs""")
def q_text_similarity(spark, sf):
    p = pairs(spark, sf)
    return p.select("resume_id", r6(V.length_similarity("csv_text", "pdf_text")).alias("text_similarity"))


@register("skill_overlap", f"""WITH {PAIRS_SQL}
SELECT resume_id, round({_jacc_sql('csv_skills', 'pdf_skills')}, 6) AS skill_overlap FROM pairs""")
def q_skill_overlap(spark, sf):
    p = pairs(spark, sf)
    return p.select("resume_id", r6(V.skill_jaccard("csv_skills", "pdf_skills")).alias("skill_overlap"))


@register("extraction_report", f"""WITH {PAIRS_SQL},
per AS (SELECT {_lensim_sql('csv_text', 'pdf_text')} AS ts, {_jacc_sql('csv_skills', 'pdf_skills')} AS so FROM pairs)
SELECT CAST(count(*) AS BIGINT) AS total_samples, round(avg(ts), 6) AS text_similarity_mean,
  round(stddev_pop(ts), 6) AS text_similarity_std, round(avg(so), 6) AS skill_overlap_mean,
  round(stddev_pop(so), 6) AS skill_overlap_std, round((avg(ts) + avg(so)) / 2, 6) AS extraction_accuracy FROM per""")
def q_extraction_report(spark, sf):
    r = V.extraction_report(pairs(spark, sf))
    return r.select(F.col("total_samples").cast("long"), *[r6(c).alias(c) for c in r.columns[1:]])


# The "archive" holds the labelled documents with digits lost in extraction;
# the CSV side is every document (inner lookup, misses skipped).
def archive_pairs(spark, sf):
    files = table(spark, sf, "labels").select(F.col("doc_id").alias("resume_id"))
    csv = documents(spark, sf).select(F.col("doc_id").alias("resume_id"), "text")
    return (files.join(csv, "resume_id")
            .select("resume_id", F.regexp_replace("text", "[0-9]", "").alias("pdf_text"),
                    F.col("text").alias("csv_text")))


def _pair_sql():
    pc, cc = clean_text_sql("pdf_text"), clean_text_sql("csv_text")
    return f"""ap AS (SELECT l.doc_id AS resume_id, regexp_replace(d.text, '[0-9]', '', 'g') AS pdf_text, d.text AS csv_text
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
pc AS (SELECT resume_id, {pc} AS p, {cc} AS c FROM ap),
pw AS (SELECT resume_id, length(p) AS pdf_length, length(c) AS csv_length,
  list_distinct({_words_sql('lower(p)')}) AS pw, list_distinct({_words_sql('lower(c)')}) AS cw FROM pc),
pv AS (SELECT resume_id, pdf_length, csv_length,
  CASE WHEN csv_length > 0 THEN pdf_length / csv_length ELSE 0.0 END AS r,
  CASE WHEN len(cw) > 0 THEN len(list_intersect(pw, cw)) / len(cw) ELSE 0.0 END AS s FROM pw)"""


@register("pair_validation", f"""WITH {_pair_sql()}
SELECT resume_id, CAST(pdf_length AS INTEGER) AS pdf_length, CAST(csv_length AS INTEGER) AS csv_length,
  round_even(r, 3) AS length_ratio, round_even(s, 3) AS text_similarity,
  r BETWEEN 0.7 AND 1.3 AND s >= 0.6 AS extraction_success FROM pv""")
def q_pair_validation(spark, sf):
    return V.pair_validation(archive_pairs(spark, sf))


# One labelled document in seven fails to extract: zeros, the raw length, the error.
@register("failed_pairs", f"""WITH {_pair_sql()},
m AS (SELECT pv.*, length(d.text) AS raw, pv.resume_id % 7 = 0 AS bad FROM pv JOIN documents d ON d.doc_id = pv.resume_id)
SELECT resume_id, CASE WHEN bad THEN 0 ELSE CAST(pdf_length AS INTEGER) END AS pdf_length,
  CAST(CASE WHEN bad THEN raw ELSE csv_length END AS INTEGER) AS csv_length,
  CASE WHEN bad THEN 0.0 ELSE round_even(r, 3) END AS length_ratio, CASE WHEN bad THEN 0.0 ELSE round_even(s, 3) END AS text_similarity,
  NOT bad AND r BETWEEN 0.7 AND 1.3 AND s >= 0.6 AS extraction_success, CASE WHEN bad THEN 'no text' END AS error FROM m""")
def q_failed_pairs(spark, sf):
    p = archive_pairs(spark, sf)
    bad = F.col("resume_id") % 7 == 0
    p = p.withColumns({"error": F.when(bad, "no text"), "pdf_text": F.when(~bad, F.col("pdf_text"))})
    return V.pair_validation(p, error_col="error")


@register("archive_validation", f"""WITH {_pair_sql()},
d AS (SELECT round_even(r, 3) AS lr, round_even(s, 3) AS ts, r BETWEEN 0.7 AND 1.3 AND s >= 0.6 AS ok FROM pv)
SELECT CAST(count(*) AS BIGINT) AS total_validated, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS successful_extractions,
  CAST(count(*) - count(*) FILTER (WHERE ok) AS BIGINT) AS failed_extractions,
  CASE WHEN count(*) > 0 THEN round_even(count(*) FILTER (WHERE ok) / count(*), 3) ELSE 0.0 END AS success_rate,
  coalesce(round_even(avg(lr), 3), 0.0) AS average_length_ratio, coalesce(round_even(avg(ts), 3), 0.0) AS average_similarity
FROM d""")
def q_archive_validation(spark, sf):
    return V.archive_validation(V.pair_validation(archive_pairs(spark, sf)))


# ---- two sources keyed by customer: last order per customer ------------------

@register("source_align", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN (
  SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
ON c_custkey = o_custkey""")
def q_source_align(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = (table(spark, sf, "orders")
              .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice",
                      F.struct("o_orderdate", "o_orderkey").alias("_ord")))
    last = V.last_per_key(orders, "c_custkey", "_ord").drop("_ord")
    return cust.join(last, "c_custkey").orderBy("c_custkey")


# Both sides hold ids more than once: the last order and the last event-like line of each customer.
@register("source_align_both", """
WITH o AS (SELECT o_custkey AS k, o_orderkey, o_orderdate FROM orders),
a AS (SELECT k, o_orderkey AS last_order FROM o QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT k, o_orderkey AS largest_order, o_totalprice FROM (SELECT o_custkey AS k, o_orderkey, o_totalprice FROM orders)
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_totalprice DESC, o_orderkey DESC) = 1)
SELECT a.k, last_order, largest_order FROM a JOIN b ON a.k = b.k""")
def q_source_align_both(spark, sf):
    o = table(spark, sf, "orders")
    a = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("last_order"), F.struct("o_orderdate", "o_orderkey").alias("_a"))
    b = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("largest_order"), F.struct("o_totalprice", "o_orderkey").alias("_b"))
    V.require_overlap(V.unmatched_counts(a, b, "k"))
    return V.align_sources(a, b, "k", "_a", "_b").select("k", "last_order", "largest_order")


@register("unmatched_counts", """
WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT CAST(count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS BIGINT) AS matched,
  CAST(count(*) FILTER (WHERE b.k IS NULL) AS BIGINT) AS only_first,
  CAST(count(*) FILTER (WHERE a.k IS NULL) AS BIGINT) AS only_second
FROM a FULL JOIN b ON a.k = b.k""")
def q_unmatched_counts(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    out = V.unmatched_counts(a, b, "k")
    return out.select(*[F.col(c).cast("long") for c in out.columns])


# ---- scoring: orders' part names against the jobs of their priority ----------

# Job requirements (ours), one or two per order priority.
JOBS = [
    ("Rigger", "1-URGENT", ["red bolt", "Blue Gear", "hot rod", "small ring"]),
    ("Fitter", "2-HIGH", ["large plate", "old anvil", "new widget"]),
    ("Welder", "3-MEDIUM", ["cold rod", "cold plate", "RED ROD", "red rod"]),
    ("Assembler", "4-NOT SPECIFIED", ["small gizmo", "blue bolt"]),
    ("Inspector", "5-LOW", ["hot gear", "new ring", "old gizmo", "large bolt", "blue anvil"]),
    ("Machinist", "5-LOW", ["red widget"]),
]


def jobs_frame(spark):
    return spark.createDataFrame([(t, c, r, [], 0, "", []) for t, c, r in JOBS], S.JOB_SCHEMA)


def _jobs_sql():
    rows = ", ".join("('%s', '%s', [%s])" % (t, c, ", ".join("'%s'" % x for x in r)) for t, c, r in JOBS)
    return f"jobs AS (SELECT * FROM (VALUES {rows}) v(job_title, job_category, required_skills))"


_ATS_SQL = f"""{_jobs_sql()},
res AS (SELECT * FROM {order_baskets_sql('p_name')}),
ats AS (SELECT r.resume_id, j.job_title,
  CASE WHEN len(r.normalized_skills) = 0 OR len(j.required_skills) = 0 THEN 0.0 ELSE
    len(list_intersect(list_distinct(list_transform(r.normalized_skills, lambda x: lower(x))),
                       list_distinct(list_transform(j.required_skills, lambda x: lower(x)))))
    / len(list_distinct(list_transform(j.required_skills, lambda x: lower(x)))) * 100.0 END AS ats_score
  FROM res r JOIN jobs j ON r.category = j.job_category)"""


@register("ats_score", f"""WITH {_ATS_SQL}
SELECT resume_id, job_title, round(ats_score, 6) AS ats_score FROM ats""")
def q_ats_score(spark, sf):
    m = S.match_jobs(order_baskets(spark, sf, "p_name"), jobs_frame(spark), zero_pairs=True)
    return m.select("resume_id", "job_title", r6("ats_score").alias("ats_score"))


@register("job_hits", f"""WITH {_ATS_SQL}
SELECT resume_id, job_title, round(ats_score, 6) AS ats_score FROM ats WHERE ats_score > 0""")
def q_job_hits(spark, sf):
    """The pairs that share a skill, straight from the inverted index."""
    m = S.match_jobs(order_baskets(spark, sf, "p_name"), jobs_frame(spark))
    return m.select("resume_id", "job_title", r6("ats_score").alias("ats_score"))


_SEM_SQL = """sem AS (SELECT CAST(a.vec_id AS VARCHAR) AS resume_id,
  CASE WHEN len(a.embedding) = 0 OR len(b.embedding) = 0 THEN 0.0 ELSE
  list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) END AS semantic_score
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def embedding_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    a = e.select(F.col("vec_id").cast("string").alias("resume_id"), F.col("vec_id").alias("_k"),
                 F.col("embedding").alias("resume_vec"))
    b = e.select((F.col("vec_id") - 1).alias("_k"), F.col("embedding").alias("job_vec"))
    return a.join(b, "_k").drop("_k")


@register("semantic_score", f"""WITH {_SEM_SQL}
SELECT resume_id, round(semantic_score, 6) AS semantic_score FROM sem""")
def q_semantic_score(spark, sf):
    p = embedding_pairs(spark, sf)
    return p.select("resume_id", r6(S.cosine("resume_vec", "job_vec")).alias("semantic_score"))


@register("both_scores", f"""WITH {_ATS_SQL}, {_SEM_SQL}
SELECT a.resume_id, a.job_title, round(a.ats_score, 6) AS ats_score,
  round(coalesce(s.semantic_score, 0.0), 6) AS semantic_score
FROM ats a LEFT JOIN sem s ON a.resume_id = s.resume_id""")
def q_both_scores(spark, sf):
    m = S.match_jobs(order_baskets(spark, sf, "p_name"), jobs_frame(spark), zero_pairs=True)
    b = S.both_scores(m, embedding_pairs(spark, sf))
    return b.select("resume_id", "job_title", r6("ats_score").alias("ats_score"),
                    r6("semantic_score").alias("semantic_score"))
