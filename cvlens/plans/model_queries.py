"""Registered queries: features, split, models and clusters (A1-A4, J7, J9, M1-M13,
W2, W5, P13-P15, A19). Fitted numbers have no SQL; the model queries return what
must hold of any right fit (test rows, valid labels, probabilities that add up,
points nearest to their own centres), which SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cvlens.functions.predicates import is_profile_noise_sql
from cvlens.functions.text import WS_RUN, strip_ws_sql
from cvlens.operators import classify as C
from cvlens.operators import cluster as K
from cvlens.operators import features as FE
from cvlens.operators import resumes as R
from cvlens.operators import textmodel as T
from cvlens.plans.registry import r6, register
from cvlens.session import free_shuffles, stored
from cvlens.sources.aliases import part_aliases
from cvlens.sources.tables import document_resumes, documents, order_baskets, order_baskets_sql, table


def structured(spark, sf, *columns):
    """Document resumes, structured, with the document's own text: id, category, skills and the ``columns`` asked for,
    and a number for each row (``_row``)."""
    docs = documents(spark, sf).select(F.col("doc_id").cast("string").alias("resume_id"), "text")
    rows = R.structure_resumes(document_resumes(spark, sf), part_aliases(spark, sf), keep_texts=False).drop("_error").join(docs, "resume_id")
    kept = rows.select("resume_id", "job_category", "normalized_skills", *columns)
    out = stored(kept.withColumn("_row", F.monotonically_increasing_id()), "structured")
    free_shuffles(spark)
    return out


_NAME_BASKETS = f"SELECT * FROM {order_baskets_sql('p_name')}"
_VOCAB_SQL = f"""vocab AS (SELECT skill, row_number() OVER (ORDER BY skill) - 1 AS idx FROM (
  SELECT DISTINCT unnest(normalized_skills) AS skill FROM ({_NAME_BASKETS})))"""


@register("vocabulary", f"""WITH {_VOCAB_SQL} SELECT skill, CAST(idx AS BIGINT) AS idx FROM vocab""")
def q_vocabulary(spark, sf):
    return FE.vocabulary(order_baskets(spark, sf, "p_name"))


@register("feature_long", f"""WITH {_VOCAB_SQL}
SELECT DISTINCT b.resume_id, CAST(v.idx AS BIGINT) AS idx FROM (
  SELECT resume_id, unnest(normalized_skills) AS skill FROM ({_NAME_BASKETS})) b JOIN vocab v ON b.skill = v.skill""")
def q_feature_long(spark, sf):
    res = order_baskets(spark, sf, "p_name")
    return FE.feature_long(res, FE.vocabulary(res))


@register("feature_vector", f"""WITH {_VOCAB_SQL},
fl AS (SELECT DISTINCT b.resume_id, v.idx FROM (
  SELECT resume_id, unnest(normalized_skills) AS skill FROM ({_NAME_BASKETS})) b JOIN vocab v ON b.skill = v.skill)
SELECT r.resume_id, coalesce(string_agg(CAST(fl.idx AS VARCHAR), ',' ORDER BY fl.idx), '') AS indices,
  CAST(count(fl.idx) AS INTEGER) AS n_active
FROM ({_NAME_BASKETS}) r LEFT JOIN fl ON r.resume_id = fl.resume_id GROUP BY r.resume_id""")
def q_feature_vector(spark, sf):
    res = order_baskets(spark, sf, "p_name")
    active = (FE.feature_long(res, FE.vocabulary(res)).groupBy("resume_id")
              .agg(F.array_sort(F.collect_list("idx")).alias("idx")))
    idx = F.coalesce("idx", F.array().cast("array<bigint>"))
    return (res.select("resume_id").join(active, "resume_id", "left")
            .select("resume_id", F.array_join(F.transform(idx, lambda i: i.cast("string")), ",").alias("indices"),
                    F.size(idx).alias("n_active")))


@register("category_counts", """
SELECT coalesce(nullif(lang, ''), 'UNKNOWN') AS category, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1""")
def q_category_counts(spark, sf):
    d = documents(spark, sf)
    return (d.select(F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("UNKNOWN")).alias("category"))
            .groupBy("category").agg(F.count("*").alias("n")))


@register("split_train_test", """
SELECT resume_id, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT CAST(doc_id AS VARCHAR) AS resume_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) AS rn,
         count(*) OVER () AS n FROM documents)""")
def q_split_train_test(spark, sf):
    d = documents(spark, sf).select(F.col("doc_id").cast("string").alias("resume_id"))
    return FE.split_train_test(d, "resume_id", 0.2, 42).select("resume_id", "split")


_TOK = f"regexp_extract_all(lower(coalesce(text, '')), '{FE.TOKEN}', 0)"


@register("tfidf", f"""WITH d AS (SELECT doc_id, text FROM documents),
n AS (SELECT count(*)::DOUBLE AS n FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOK}) AS term FROM d) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + n) / (1.0 + df.df)) + 1.0) AS w FROM tf JOIN df USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf(spark, sf):
    t = FE.tfidf_long(table(spark, sf, "documents").select("doc_id", "text"))  # dealt by document in there
    return t.select("doc_id", "term", r6("weight").alias("weight"))


# ---- models ------------------------------------------------------------------

_SPLIT_SQL = """sp AS (SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS category,
  row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR))) <= ceil(count(*) OVER () * 0.2) AS is_test FROM documents)"""

_TEST_SQL = f"""WITH {_SPLIT_SQL}
SELECT resume_id, category, true AS known_label FROM sp WHERE is_test"""

_OPTIMUM_SQL = f"""WITH {_SPLIT_SQL}
SELECT resume_id, category, true AS known_label, true AS at_optimum FROM sp WHERE is_test"""


def _split_structured(spark, sf):
    vectors, _ = R.resume_features(structured(spark, sf))
    vectors = vectors.select("resume_id", F.col("job_category").alias("category"), "normalized_skills", F.col("features").alias("skill_vec"))
    return FE.split_train_test(vectors, "resume_id")


def _split_documents(spark, sf):
    d = documents(spark, sf).select(F.col("doc_id").cast("string").alias("resume_id"), F.col("lang").alias("category"), "text")
    out = stored(FE.split_train_test(d, "resume_id").withColumn("_row", F.monotonically_increasing_id()), "split")
    free_shuffles(spark)
    return out


def _split_lists(spark, sf):
    """The stored rows with their side, which their ids decide."""
    s = structured(spark, sf, "text").select("resume_id", F.col("job_category").alias("category"), "text", "normalized_skills", "_row")
    return FE.split_train_test(s, "resume_id")


def _fit_text(spark, sf, hybrid: bool):
    """(fitted model, test rows): the baseline reads texts only, the hybrid skill lists too."""
    sp = _split_lists(spark, sf) if hybrid else _split_documents(spark, sf)
    return T.train(sp.where("split = 'train'"), "category", "text", "normalized_skills" if hybrid else None, row_col="_row"), sp.where("split = 'test'")


def _known(model, said):
    return said.select("resume_id", "category", F.col("prediction").isin(model.labels).alias("known_label"))


def _at_optimum(spark, sf, hybrid):
    """Test rows, whether the prediction is a training label, and whether the model is the loss's one optimum."""
    model, test = _fit_text(spark, sf, hybrid)
    return _known(model, model.transform(test, "_row")).withColumn("at_optimum", F.lit(model.gradient_size() <= 1.05e-4))


@register("baseline_lr", _OPTIMUM_SQL)
def q_baseline_lr(spark, sf):
    return _at_optimum(spark, sf, False)


@register("hybrid_lr", _OPTIMUM_SQL)
def q_hybrid_lr(spark, sf):
    return _at_optimum(spark, sf, True)


@register("baseline_predictions")
def q_baseline_predictions(spark, sf):
    """Prediction and its probability of every test row (no SQL: the optimum of an iterative fit)."""
    model, test = _fit_text(spark, sf, False)
    return model.transform(test, "_row").select("resume_id", "category", "prediction", F.array_max("probability").alias("confidence"))


@register("hybrid_probabilities")
def q_hybrid_probabilities(spark, sf):
    """The probability of every class for every test row (no SQL: the optimum of an iterative fit)."""
    model, test = _fit_text(spark, sf, True)
    return model.predict_proba(test, row_col="_row")


@register("model_shape", f"""WITH {_SPLIT_SQL},
t AS (SELECT category, unnest({_TOK}) AS term FROM documents JOIN sp ON resume_id = CAST(doc_id AS VARCHAR) WHERE NOT is_test),
c AS (SELECT DISTINCT category FROM sp WHERE NOT is_test)
SELECT kind, class, n, sums_to_zero FROM (SELECT 'term' AS kind, c.category AS class, (SELECT count(DISTINCT term) FROM t) AS n, true AS sums_to_zero FROM c
  UNION ALL SELECT 'intercept', c.category, 1, true FROM c)""")
def q_model_shape(spark, sf):
    """Coefficients by kind and class: one of each term a class; at the optimum the classes' coefficients of a term add up to 0."""
    model, _ = _fit_text(spark, sf, False)
    table = stored(model.coefficients(), "coefficient-names")
    sums = table.groupBy("kind", "name").agg(F.sum("weight").alias("s"))
    even = sums.groupBy("kind").agg((F.max(F.abs("s")) < 1e-6).alias("sums_to_zero"))
    return table.groupBy("kind", "class").agg(F.count("*").alias("n")).join(even, "kind").select("kind", "class", "n", "sums_to_zero")


@register("skill_rf", f"""WITH {_SPLIT_SQL}
SELECT resume_id, category, true AS known_label, true AS above_majority FROM sp WHERE is_test""")
def q_skill_rf(spark, sf):
    """Test rows, whether the prediction is a training label, and whether the forest beats the commonest label on its training rows."""
    sp = _split_structured(spark, sf)
    train = sp.where("split = 'train'")
    model = C.train_forest(train, features_col="skill_vec")
    right = model.transform(train).agg(F.count_if(F.col("prediction") == F.col("category"))).first()[0]
    most = train.groupBy("category").count().agg(F.max("count")).first()[0]
    return _known(model, model.transform(sp.where("split = 'test'"))).withColumn("above_majority", F.lit(right > most))


@register("rf_predictions")
def q_rf_predictions(spark, sf):
    """Class probabilities of the forest for every test row (no SQL: random trees)."""
    sp = _split_structured(spark, sf)
    return C.train_forest(sp.where("split = 'train'"), features_col="skill_vec").predict_proba(sp.where("split = 'test'"))


@register("predict_proba", f"""WITH {_SPLIT_SQL}
SELECT resume_id, (SELECT CAST(count(DISTINCT category) AS BIGINT) FROM sp WHERE NOT is_test) AS n_classes,
  CAST(1.0 AS DOUBLE) AS total, true AS best_is_prediction FROM sp WHERE is_test""")
def q_predict_proba(spark, sf):
    """Per test row: how many classes, what their probabilities add up to, whether the likeliest is the prediction."""
    model, test = _fit_text(spark, sf, True)
    said = model.transform(test, "_row").select("resume_id", "prediction")
    per = (model.predict_proba(test, row_col="_row").groupBy("resume_id")
           .agg(F.count("*").alias("n_classes"), r6(F.sum("probability")).alias("total"),
                F.max_by("class", "probability").alias("best")))
    return per.join(said, "resume_id").select("resume_id", "n_classes", "total", (F.col("best") == F.col("prediction")).alias("best_is_prediction"))


@register("validate_models", """
SELECT CAST(count(*) AS BIGINT) AS n, true AS baseline_above_majority, true AS proposed_above_majority FROM documents""")
def q_validate_models(spark, sf):
    """Both text models applied to the second source (text with digits lost), against the commonest label's share."""
    sp = _split_lists(spark, sf)
    fit = lambda skills: T.train(sp.where("split = 'train'"), "category", "text", skills, row_col="_row")
    second = sp.withColumn("text", F.regexp_replace("text", "[0-9]", ""))
    got = T.validate_models(second, fit("normalized_skills"), fit(None), row_col="_row")
    share = (sp.groupBy("category").agg(F.count("*").alias("c"))
             .agg(F.sum("c").alias("n"), (F.max("c") / F.sum("c")).alias("share")))
    above = lambda c: (F.col(c) > F.col("share")) & (F.col(c) <= 1.0)
    return share.crossJoin(got).select("n", above("baseline_accuracy").alias("baseline_above_majority"),  # one row each
                                       above("proposed_accuracy").alias("proposed_above_majority"))


# ---- clusters -------------------------------------------------------------------

def _embeddings(spark, sf):
    return table(spark, sf, "embeddings")


def _kmeans(spark, sf):
    """(fit, vec_id, cluster and the vector as v)."""
    e = _embeddings(spark, sf).select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    model = K.fit_kmeans(e, "v", k=10, n_init=10, seed=42)
    return model, stored(model.transform(e), "kmeans-assigned")


@register("kmeans_assign", """SELECT vec_id, true AS nearest_own_centre, true AS cost_is_least, true AS cost_adds_up, true AS centres_are_means FROM embeddings""")
def q_kmeans_assign(spark, sf):
    """Whether each point is nearest to the centre of its own cluster, whether the chosen start costs least of the
    ten and what its points add up to, and whether its centres are the means of their members (nearly: rest is by tol)."""
    model, given = _kmeans(spark, sf)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centers])  # k x dim numbers
    far = given.withColumn("d", F.transform(centres, lambda c: F.aggregate(
        F.zip_with("v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)))
    far = stored(far.select("vec_id", F.element_at("d", F.col("cluster") + 1).alias("own"), F.array_min("d").alias("least")), "kmeans-distances")
    cost = far.agg(F.sum("own").alias("c")).first()["c"]
    means = K.centroids_long(given, "v").withColumn("c", F.element_at(F.element_at(centres, F.col("cluster") + 1), F.col("dim") + 1))
    apart = means.agg(F.max(F.abs(F.col("value") - F.col("c"))).alias("a")).first()["a"]
    return far.select("vec_id", (F.col("own") <= F.col("least") + 1e-9).alias("nearest_own_centre"),
                      F.lit(len(model.costs) == 10 and model.cost <= min(model.costs)).alias("cost_is_least"),
                      F.lit(abs(cost - model.cost) <= 1e-6 * model.cost).alias("cost_adds_up"), F.lit(apart < 0.05).alias("centres_are_means"))


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf):
    """Each vector's cluster (no SQL: the best of ten drawn starts)."""
    return _kmeans(spark, sf)[1].select("vec_id", "cluster")


@register("cluster_report", """SELECT CAST(count(*) AS BIGINT) AS sample_count, CAST(5 AS BIGINT) AS requested_cluster_count,
  true AS clusters_in_range, true AS silhouette_in_range, CAST(count(*) AS BIGINT) AS in_sizes, CAST(count(*) AS BIGINT) AS in_categories,
  CAST(count(*) AS BIGINT) AS assigned, true AS every_cluster_has_profile FROM documents""")
def q_cluster_report(spark, sf):
    """The cluster pipeline on skill vectors, written as JSON and read back: its parts agree."""
    from cvlens.sources.files import scratch_dir
    report = R.cluster_resumes(structured(spark, sf), k=5, top_n=5)
    path = scratch_dir(spark, "cluster-report")
    R.write_cluster_report(report, path)
    back = {n: spark.read.schema(getattr(report, n).schema).json(f"{path}/{n}")
            for n in ("assignments", "sizes", "categories", "profiles", "summary")}
    one = back["summary"].select(
        "sample_count", "requested_cluster_count",
        F.col("actual_cluster_count").between(1, F.col("requested_cluster_count")).alias("clusters_in_range"),
        F.col("silhouette_score").between(-1.0, 1.0).alias("silhouette_in_range"))
    sizes = back["sizes"].join(back["profiles"].select("cluster", F.lit(True).alias("_has")).distinct(), "cluster", "left").agg(
        F.sum("size").alias("in_sizes"), F.every(F.coalesce("_has", F.lit(False))).alias("every_cluster_has_profile"))
    categories = back["categories"].agg(F.sum("count").alias("in_categories"))
    assigned = back["assignments"].agg(F.countDistinct("resume_id").alias("assigned"))
    return one.crossJoin(sizes).crossJoin(categories).crossJoin(assigned)  # one row each


_EMB_LONG = """el AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
  generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)"""


@register("centroids", f"""WITH {_EMB_LONG}
SELECT label AS cluster, CAST(dim AS INTEGER) AS dim, round(avg(v), 6) AS value FROM el GROUP BY label, dim""")
def q_centroids(spark, sf):
    c = K.centroids_long(_embeddings(spark, sf), "embedding", "label")
    return c.select(F.col("label").alias("cluster"), "dim", r6("value").alias("value"))


@register("silhouette", f"""WITH {_EMB_LONG},
d AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS dist
      FROM el a JOIN el b ON a.dim = b.dim AND a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.vec_id, b.label),
m AS (SELECT i, li, lj, avg(dist) AS md FROM d GROUP BY i, li, lj),
p AS (SELECT i, max(CASE WHEN li = lj THEN md END) AS a, min(CASE WHEN li <> lj THEN md END) AS b FROM m GROUP BY i)
SELECT round(avg(CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6)
  AS silhouette, (SELECT CAST(count(DISTINCT label) AS BIGINT) FROM embeddings) AS n_clusters FROM p""")
def q_silhouette(spark, sf):
    named = _embeddings(spark, sf).withColumn("name", F.concat(F.lit("VEC"), F.col("vec_id")))
    s = K.silhouette(named, "name", "embedding", "label")
    return s.select(r6("silhouette").alias("silhouette"), "n_clusters")


# Orders clustered by their priority; skills are their parts' names, to which every order adds labels that the
# noise rule drops and one that formatting repairs.
_NOISY = ["Name City", "jobs@example.com", "www.example.org", "summary", "tidy   label"]

_BASKETS_SQL = f"""SELECT resume_id, category, list_concat(normalized_skills, [{", ".join(f"'{x}'" for x in _NOISY)}]) AS normalized_skills
  FROM ({_NAME_BASKETS})"""


def _noisy_baskets(spark, sf):
    extra = F.array(*[F.lit(x) for x in _NOISY])
    return order_baskets(spark, sf, "p_name").withColumn("normalized_skills", F.concat("normalized_skills", extra))


_PROFILE_SQL = f"""b AS ({_BASKETS_SQL}),
sz AS (SELECT category AS cluster, count(*) AS n FROM b GROUP BY 1),
pr AS (SELECT category AS cluster, skill, count(*) AS m FROM (
  SELECT DISTINCT resume_id, category, unnest(normalized_skills) AS skill FROM b) GROUP BY 1, 2)"""


@register("cluster_profiles", f"""WITH {_PROFILE_SQL}
SELECT cluster, CAST(rank AS INTEGER) AS rank, regexp_replace({strip_ws_sql('skill')}, '{WS_RUN}', ' ', 'g') AS skill,
  round(weight, 6) AS weight FROM (
  SELECT pr.cluster, pr.skill, pr.m / sz.n AS weight,
         row_number() OVER (PARTITION BY pr.cluster ORDER BY pr.m / sz.n DESC, pr.skill DESC) AS rank
  FROM pr JOIN sz USING (cluster) WHERE NOT {is_profile_noise_sql('pr.skill')}) WHERE rank <= 5""")
def q_cluster_profiles(spark, sf):
    a = _noisy_baskets(spark, sf).withColumnRenamed("category", "cluster")
    p = K.cluster_profiles(a, "normalized_skills", "cluster", top_n=5)
    return p.select("cluster", "rank", "skill", r6("weight").alias("weight"))


@register("cluster_sizes", f"""WITH {_PROFILE_SQL}
SELECT cluster, CAST(n AS BIGINT) AS size FROM sz""")
def q_cluster_sizes(spark, sf):
    a = order_baskets(spark, sf, "p_name").withColumnRenamed("category", "cluster")
    return K.cluster_sizes(a)


@register("cluster_categories", """
SELECT o_orderpriority AS cluster, o_orderstatus AS category, CAST(count(*) AS BIGINT) AS count
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2""")
def q_cluster_categories(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("resume_id"),
                                          F.col("o_orderstatus").alias("category"))
    a = order_baskets(spark, sf, "p_name").select("resume_id", F.col("category").alias("cluster")).join(o, "resume_id")
    return K.cluster_categories(a)
