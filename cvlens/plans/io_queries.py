"""Registered queries: sources and sinks as round trips of table data
(S1-S10, K1-K6, E10, J5, P13-P17, W1). Files go to a fresh folder under the
session's shared checkpoint folder."""

from __future__ import annotations

import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cvlens import sinks
from cvlens.functions.predicates import is_noise_skill, is_noise_skill_sql
from cvlens.functions.text import clean_text_sql, decode_text, strip_ws_sql
from cvlens.operators import classify as C
from cvlens.operators import cluster as K
from cvlens.operators import features as FE
from cvlens.operators import metrics as M
from cvlens.operators import mining as MI
from cvlens.operators import resumes as R
from cvlens.operators import scoring as S
from cvlens.operators import textmodel as T
from cvlens.operators import validation as V
from cvlens.plans import eval_queries as E
from cvlens.plans import mining_queries as MQ
from cvlens.plans import model_queries as MO
from cvlens.plans.registry import r6, register
from cvlens.plans.skill_queries import _UNIQ_SQL, SKILLS_SQL
from cvlens.session import free_shuffles, stored
from cvlens.sources import files as FS
from cvlens.sources.aliases import load_alias_lines, part_aliases, part_aliases_sql
from cvlens.sources.tables import document_resumes, documents, order_baskets, table


def _doc_rows(spark, sf):
    d = documents(spark, sf)
    return d.select(F.col("doc_id").cast("string").alias("resume_id"), F.col("lang").alias("category"),
                    F.col("text").alias("resume_str"), F.col("source").alias("resume_html"))


# Every document, and once more with white space around its text.
@register("csv_roundtrip", """
SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS category, text AS resume_str FROM documents
UNION ALL SELECT 'E' || doc_id, lang, '  ' || chr(9) || text || ' ' || chr(10) || ' ' FROM documents""")
def q_csv_roundtrip(spark, sf):
    path = FS.scratch_dir(spark, "csv")
    rows = _doc_rows(spark, sf)
    edged = rows.withColumns({"resume_id": F.concat(F.lit("E"), "resume_id"),
                              "resume_str": F.concat(F.lit("  \t"), "resume_str", F.lit(" \n "))})
    FS.write_resume_csv(rows.unionByName(edged), path)
    return FS.read_resume_csv(spark, path).select("resume_id", "category", "resume_str")


@register("row_index", """SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS first, CAST(count(*) - 1 AS BIGINT) AS last,
  CAST(count(*) AS BIGINT) AS different, true AS in_source, true AS in_file_order, true AS many_files FROM documents""")
def q_row_index(spark, sf):
    """Rows of an export of many CSV files are numbered in the files' order, gapless from 0, and named in their source."""
    path = FS.scratch_dir(spark, "csv-ordered")
    number = F.col("resume_id").cast("long")
    FS.write_resume_csv(_doc_rows(spark, sf).repartitionByRange(12, number).sortWithinPartitions(number), path)
    back = stored(FS.read_resume_csv(spark, path, with_row_index=True), "row-index")
    before = back.select((F.col("row_idx") + 1).alias("row_idx"), F.col("resume_id").cast("long").alias("_before"))
    ordered = back.join(before, "row_idx").agg(F.every(F.col("_before") < F.col("resume_id").cast("long")).alias("in_file_order"))
    files = len(spark.read.text(path).inputFiles())
    facts = back.agg(F.count("*").alias("n"), F.min("row_idx").alias("first"), F.max("row_idx").alias("last"),
                     F.countDistinct("row_idx").alias("different"),
                     F.every(F.endswith("source", F.concat(F.lit(":row_"), F.col("row_idx").cast("string")))).alias("in_source"))
    return facts.crossJoin(ordered).withColumn("many_files", F.lit(files >= 8))  # one row each


@register("required_columns", """SELECT 'whole' AS export, true AS accepted, CAST(count(*) AS BIGINT) AS n FROM documents
UNION ALL SELECT 'without_category', false, CAST(0 AS BIGINT)""")
def q_required_columns(spark, sf):
    """An export without a required column is refused before any row is read; of the whole one its rows are read."""
    out = None
    for name, drop in (("whole", []), ("without_category", ["Category"])):
        path = FS.scratch_dir(spark, "columns")
        rows = _doc_rows(spark, sf).select(F.col("resume_id").alias("ID"), F.col("resume_str").alias("Resume_str"),
                                           F.col("resume_html").alias("Resume_html"), F.col("category").alias("Category")).drop(*drop)
        rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        try:
            read, accepted = FS.read_resume_csv(spark, path), True
        except ValueError:
            read, accepted = rows.limit(0), False
        one = read.agg(F.count("*").alias("n")).select(F.lit(name).alias("export"), F.lit(accepted).alias("accepted"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# Bytes of every document: Latin-1 where it can spell the text and is no valid UTF-8, else UTF-8; CRLF line ends.
@register("decode_fallback", """SELECT doc_id, replace(text, chr(13), '') AS text FROM documents""")
def q_decode_fallback(spark, sf):
    d = documents(spark, sf).select("doc_id", F.regexp_replace("text", "\r?\n", "\r\n").alias("text"))
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", ""), "ISO-8859-1")
    fits = (F.regexp_replace("text", r"[^\x00-\xff]", "") == F.col("text")) & ~F.is_valid_utf8(latin.cast("string"))
    return d.select("doc_id", decode_text(F.when(fits, latin).otherwise(F.encode("text", "UTF-8"))).alias("text"))


# One document in ten each: a .pdf, an empty file, a file with NUL bytes, another extension; .TXT counts as .txt.
def _loaded_files(spark, sf):
    kind = F.col("doc_id") % 10
    ext = F.when(kind == 1, ".pdf").when(kind == 4, ".docx").when(kind == 5, ".TXT").otherwise(".txt")
    body = F.encode("text", "UTF-8")
    content = F.when(kind == 2, F.lit(b"")).when(kind == 3, F.concat(F.lit(b"\x00\x01"), body)).otherwise(body)
    return documents(spark, sf).select(F.concat(F.lit("store/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), ext).alias("path"),
                                       content.alias("content"))


_ERROR_SQL = """CASE doc_id % 10 WHEN 1 THEN 'no decoder for .pdf' WHEN 2 THEN 'no content' WHEN 3 THEN 'binary content'
  WHEN 4 THEN 'extension not accepted' END"""


@register("quarantine", f"""SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS category, {_ERROR_SQL} AS error,
  CASE WHEN {_ERROR_SQL} IS NULL THEN CAST(length(text) AS INTEGER) END AS n_chars FROM documents""")
def q_quarantine(spark, sf):
    rows = FS.quarantine(_loaded_files(spark, sf))
    return rows.select("resume_id", "category", F.col("_error").alias("error"), F.length("resume_str").alias("n_chars"))


@register("quarantine_counts", f"""SELECT CAST(count(*) FILTER (WHERE {_ERROR_SQL} IS NULL) AS BIGINT) AS processed,
  CAST(count(*) FILTER (WHERE {_ERROR_SQL} IS NOT NULL) AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total FROM documents""")
def q_quarantine_counts(spark, sf):
    return FS.quarantine_counts(FS.quarantine(_loaded_files(spark, sf)))


# The same files on disk, where Spark's scan leaves out those without bytes; every row of the result is one file.
@register("archive_faults", f"""SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS job_category, {_ERROR_SQL} AS error,
  CASE WHEN {_ERROR_SQL} IS NULL THEN CAST(length({clean_text_sql('text')}) AS INTEGER) END AS n_clean,
  true AS named, true AS dated FROM documents WHERE doc_id % 10 <> 2""")
def q_archive_faults(spark, sf):
    """Files of all kinds through reader, cleaning, sections, skills and normalisation: faults arrive as rows."""
    root = FS.scratch_dir(spark, "faults")
    files = _loaded_files(spark, sf)
    FS.write_files(files.select(F.regexp_replace("path", "^store/", "").alias("name"), "content"), root)
    began = F.lit(datetime.datetime.now(datetime.timezone.utc).isoformat()).cast("timestamp") - F.expr("INTERVAL 1 SECOND")
    rows = R.structure_resumes(FS.read_archive(spark, root, "*", faults=True), part_aliases(spark, sf))
    path, when = F.col("metadata.file_path"), F.to_timestamp("metadata.processed_date")
    return stored(rows, "archive-faults").select(
        "resume_id", "job_category", F.col("_error").alias("error"), F.length("sections.raw_text").alias("n_clean"),
        F.contains(path, F.concat(F.lit("/"), "job_category", F.lit("/"), "resume_id", F.lit("."))).alias("named"),
        when.between(began, F.current_timestamp()).alias("dated"))


@register("fault_counts", f"""SELECT 'read' AS stage, CAST(count(*) FILTER (WHERE {_ERROR_SQL} IS NULL) AS BIGINT) AS processed,
  CAST(count(*) FILTER (WHERE {_ERROR_SQL} IS NOT NULL) AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total FROM documents
UNION ALL SELECT 'structured', count(*) FILTER (WHERE {_ERROR_SQL} IS NULL), count(*) FILTER (WHERE {_ERROR_SQL} IS NOT NULL), count(*) FROM documents""")
def q_fault_counts(spark, sf):
    """What the reader passes on and what comes out at the end, good and quarantined."""
    read = FS.quarantine(_loaded_files(spark, sf))
    good, bad = R.split_faults(R.structure_resumes(read, part_aliases(spark, sf)))
    ends = good.select(F.lit(None).cast("string").alias("_error")).unionByName(bad.select(F.col("error").alias("_error")))
    return FS.quarantine_counts(read).withColumn("stage", F.lit("read")).unionByName(FS.quarantine_counts(ends).withColumn("stage", F.lit("structured")))


# Documents as a CSV export of many files, read back and turned into the skill matrix.
@register("csv_features", f"""WITH {SKILLS_SQL}, {_UNIQ_SQL},
lg AS (SELECT resume_id, unnest(list_concat(explicit_skills, implicit_skills)) AS raw FROM k),
nm AS (SELECT DISTINCT lg.resume_id, coalesce(m.normalized, '') AS skill FROM lg LEFT JOIN mapping m ON {strip_ws_sql('lg.raw')} = m.skill),
vocab AS (SELECT skill, row_number() OVER (ORDER BY skill) - 1 AS idx FROM (SELECT DISTINCT skill FROM nm))
SELECT k.resume_id, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS indices, CAST(count(idx) AS INTEGER) AS n_active,
  true AS as_vector FROM k LEFT JOIN nm ON k.resume_id = nm.resume_id LEFT JOIN vocab USING (skill) GROUP BY k.resume_id""")
def q_csv_features(spark, sf):
    path = FS.scratch_dir(spark, "csv-features")
    FS.write_resume_csv(document_resumes(spark, sf).repartition(8), path)
    free_shuffles(spark)
    done = R.structure_resumes(FS.read_resume_csv(spark, path, with_row_index=True), part_aliases(spark, sf), keep_texts=False)
    fine = stored(done.where("_error IS NULL").select("resume_id", "job_category", "normalized_skills"), "csv-structured")
    free_shuffles(spark)
    vectors, _ = R.resume_features(fine)
    ones = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return vectors.select("resume_id", F.array_join(F.transform("feature_idx", lambda i: i.cast("string")), ",").alias("indices"),
                          F.size("feature_idx").alias("n_active"), (ones == F.size("feature_idx")).alias("as_vector"))


# What the steps refuse, each on the tables' own rows: nothing to mine, to cluster or to split, shares and counts out of range.
@register("input_guards", """SELECT guard, true AS refused, (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS n
FROM (VALUES ('empty vocabulary'), ('nothing to mine'), ('support out of range'), ('one cluster'), ('more clusters than rows'),
  ('no profile label'), ('test share'), ('no common ids')) v(guard)""")
def q_input_guards(spark, sf):
    baskets = stored(order_baskets(spark, sf, "p_type"), "guard-baskets")
    none, ids = baskets.limit(0), baskets.select("resume_id")
    n = baskets.count()
    vectors = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("v"))
    guards = {"empty vocabulary": lambda: FE.vocabulary(none), "nothing to mine": lambda: MI.mine_associations(none),
              "support out of range": lambda: MI.mine_associations(baskets, 1.5, 0.5), "one cluster": lambda: K.fit_kmeans(vectors, "v", k=1),
              "more clusters than rows": lambda: K.fit_kmeans(vectors.limit(3), "v", k=4),
              "no profile label": lambda: K.cluster_profiles(baskets, "normalized_skills", "category", top_n=0),
              "test share": lambda: FE.split_train_test(ids, test_size=1.0),
              "no common ids": lambda: V.require_overlap(V.unmatched_counts(ids, ids.select(F.concat(F.lit("x"), "resume_id").alias("resume_id")), "resume_id"))}
    rows = []
    for name, guard in guards.items():
        try:
            guard()
            refused = False
        except ValueError:
            refused = True
        rows.append((name, refused, n))
    return spark.createDataFrame(rows, "guard string, refused boolean, n long")


def _archive(spark, sf):
    root = FS.scratch_dir(spark, "archive")
    FS.write_archive(_doc_rows(spark, sf), root)
    # and a plain file in the root for each language, which is no resume
    stray = _doc_rows(spark, sf).groupBy("category").agg(F.min("resume_str").alias("resume_str"))
    FS.write_archive(stray.select(F.concat(F.lit("stray-"), "category").alias("resume_id"), F.lit(".").alias("category"), "resume_str"), root)
    return root


@register("archive_scan", """
SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS category, text AS resume_str FROM documents""")
def q_archive_scan(spark, sf):
    return FS.read_archive(spark, _archive(spark, sf)).select("resume_id", "category", "resume_str")


@register("flat_scan", """
SELECT CAST(doc_id AS VARCHAR) AS resume_id, 'UNKNOWN' AS category, CAST(length(text) AS INTEGER) AS n_chars FROM documents""")
def q_flat_scan(spark, sf):
    root = FS.scratch_dir(spark, "flat")
    FS.write_archive(_doc_rows(spark, sf).withColumn("category", F.lit("all")), root)
    df = FS.read_flat(spark, f"{root}/all")
    return df.select("resume_id", "category", F.length("resume_str").alias("n_chars"))


@register("bounded_sample", """
SELECT CAST(d.doc_id AS VARCHAR) AS resume_id, d.lang AS category FROM labels l JOIN documents d ON l.doc_id = d.doc_id
ORDER BY CAST(d.doc_id AS VARCHAR) LIMIT 100""")
def q_bounded_sample(spark, sf):
    """Archive files limited to the first 100 ids, then looked up in the CSV rows (inner)."""
    root = FS.scratch_dir(spark, "labelled")
    labelled = _doc_rows(spark, sf).join(
        table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("resume_id")), "resume_id")
    FS.write_archive(labelled, root)
    files = FS.sample_archive(spark, root, 100)
    csv = _doc_rows(spark, sf).select("resume_id", F.col("category").alias("csv_category"))
    return files.join(csv, "resume_id").select("resume_id", F.col("csv_category").alias("category"))


@register("structured_json_roundtrip", """
SELECT resume_id, category AS job_category, n_chars AS text_length, true AS scores_null FROM (
  SELECT CAST(doc_id AS VARCHAR) AS resume_id, lang AS category, CAST(length(text) AS INTEGER) AS n_chars FROM documents)""")
def q_structured_json_roundtrip(spark, sf):
    d = _doc_rows(spark, sf)
    structured = d.select(
        "resume_id", F.col("category").alias("job_category"),
        F.struct(F.lit("").alias("skills"), F.col("resume_str").alias("experience"), F.lit("").alias("education"),
                 F.lit("").alias("projects"), F.col("resume_str").alias("raw_text")).alias("sections"),
        F.struct(F.array().cast("array<string>").alias("explicit_skills"),
                 F.array().cast("array<string>").alias("implicit_skills")).alias("skills"),
        F.array().cast("array<string>").alias("normalized_skills"),
        F.lit(None).cast("struct<ats_score:double,semantic_score:double>").alias("scores"),
        F.struct(F.concat(F.lit("table:documents:"), F.col("resume_id")).alias("file_path"),
                 F.lit("1970-01-01T00:00:00").alias("processed_date"),
                 F.lit(0).alias("processing_time_ms")).alias("metadata"))
    path = FS.scratch_dir(spark, "structured")
    sinks.write_structured(structured, path)
    back = sinks.read_structured(spark, path)
    return back.select("resume_id", "job_category", F.length("sections.raw_text").alias("text_length"),
                       F.col("scores").isNull().alias("scores_null"))


# ---- reports, rules, validation and models as files -----------------------------

_REPORT_SQL = f"""WITH {E.PRED_SQL}
SELECT round(b.accuracy, 6) AS baseline_accuracy, round(p.accuracy, 6) AS accuracy, round(p.macro_f1, 6) AS macro_f1,
  round(p.accuracy - b.accuracy, 6) AS accuracy_improvement, CAST(2 AS INTEGER) AS n_sections
FROM {E._macro_sql('label', 'baseline')} b, {E._macro_sql('label', 'prediction')} p"""


def _evaluation(spark, sf):
    p = E.predictions(spark, sf)
    own = M.classification_summary(p)
    return M.combined_report(spark, classification=own, fairness=None,
                             model_comparison=M.compare_models(M.classification_summary(p, "label", "baseline"), own))


def _report_columns(rep):
    return rep.select(r6("model_comparison.baseline_accuracy").alias("baseline_accuracy"), r6("classification.accuracy").alias("accuracy"),
                      r6("classification.macro_f1").alias("macro_f1"),
                      r6("model_comparison.accuracy_improvement").alias("accuracy_improvement"),
                      F.lit(len(rep.columns)).alias("n_sections"))


@register("combined_report", _REPORT_SQL)
def q_combined_report(spark, sf):
    return _report_columns(_evaluation(spark, sf))


@register("report_sink", _REPORT_SQL)
def q_report_sink(spark, sf):
    rep = _evaluation(spark, sf)
    path = FS.scratch_dir(spark, "report")
    sinks.write_report(rep, path)
    return _report_columns(spark.read.schema(rep.schema).json(path))


@register("rules_sink", f"""{MQ._RULES_SQL}
SELECT {MQ._RULE_COLS} FROM rules WHERE confidence >= {MQ.MIN_CONFIDENCE}""")
def q_rules_sink(spark, sf):
    rules = MQ._mined(spark, sf).rules
    path = FS.scratch_dir(spark, "rules")
    sinks.write_report(rules, path)
    return MQ._rule_cols(spark.read.schema(rules.schema).json(path))


@register("validation_sink", f"""WITH {E._pair_sql()}
SELECT CAST(count(*) AS BIGINT) AS total_validated,
  CAST(count(*) FILTER (WHERE r BETWEEN 0.7 AND 1.3 AND s >= 0.6) AS BIGINT) AS successful_extractions FROM pv""")
def q_validation_sink(spark, sf):
    rep = V.archive_validation(V.pair_validation(E.archive_pairs(spark, sf)))
    path = FS.scratch_dir(spark, "validation")
    sinks.write_report(rep, path)
    return spark.read.schema(rep.schema).json(path).select("total_validated", "successful_extractions")


@register("vocabulary_sink", f"""WITH {MO._VOCAB_SQL} SELECT skill, CAST(idx AS BIGINT) AS idx FROM vocab""")
def q_vocabulary_sink(spark, sf):
    path = FS.scratch_dir(spark, "vocabulary")
    sinks.write_vocabulary(MO.FE.vocabulary(order_baskets(spark, sf, "p_name")), path)
    return spark.read.parquet(path)


@register("model_roundtrip", f"""WITH {MO._SPLIT_SQL} SELECT resume_id, true AS same FROM sp WHERE is_test""")
def q_model_roundtrip(spark, sf):
    """A saved and loaded forest predicts the same."""
    sp = MO._split_structured(spark, sf)
    model = C.train_forest(sp.where("split = 'train'"), features_col="skill_vec")
    path = FS.scratch_dir(spark, "model")
    sinks.save_classifier(model, path)
    again = sinks.load_classifier(path)
    said = lambda m, c: m.transform(sp.where("split = 'test'")).select("resume_id", F.col("prediction").alias(c))
    return said(model, "a").join(said(again, "b"), "resume_id").select("resume_id", (F.col("a") == F.col("b")).alias("same"))


@register("text_model_roundtrip", f"""WITH {MO._SPLIT_SQL} SELECT resume_id, true AS same FROM sp WHERE is_test""")
def q_text_model_roundtrip(spark, sf):
    """A saved and loaded text model gives the same probabilities."""
    sp = MO._split_documents(spark, sf)
    test = sp.where("split = 'test'").select("resume_id", "text", "_row")
    model = T.train(sp.where("split = 'train'"), "category", row_col="_row")
    path = FS.scratch_dir(spark, "text-model")
    model.save(path)
    said = lambda m, c: m.transform(test, "_row").select("resume_id", F.col("probability").alias(c))
    near = F.forall(F.zip_with("a", "b", lambda x, y: F.abs(x - y) < 1e-9), lambda x: x)
    return said(model, "a").join(said(T.load(spark, path), "b"), "resume_id").select("resume_id", near.alias("same"))


# ---- dictionaries and jobs from files --------------------------------------------

@register("alias_file", f"""SELECT alias, min(canonical) AS canonical FROM {part_aliases_sql()} GROUP BY alias""")
def q_alias_file(spark, sf):
    """The dictionary as lines of JSON objects, some nested, with names that lose and values that are no names beside it."""
    own = part_aliases(spark, sf).groupBy("alias").agg(F.min("canonical").alias("canonical"))
    one = F.to_json(F.create_map("alias", "canonical"))
    nested = F.concat(F.lit('{"aliases":'), one, F.lit(',"aliasless":"no"}'))
    loses = F.to_json(F.create_map(F.col("alias"), F.concat("canonical", F.lit("~"))))
    lines = own.select(F.explode(F.array(F.when(F.length("alias") % 2 == 0, one).otherwise(nested), loses,
                                         F.lit('{"number":5,"nothing":null}'))).alias("value"))
    path = FS.scratch_dir(spark, "aliases")
    lines.write.text(path)
    return load_alias_lines(spark, path)


@register("job_match", f"""WITH {E._ATS_SQL}
SELECT resume_id, job_title, round(ats_score, 6) AS ats_score FROM ats""")
def q_job_match(spark, sf):
    """Jobs read from their JSON documents, matched to the orders' baskets."""
    path = FS.scratch_dir(spark, "jobs")
    E.jobs_frame(spark).write.option("maxRecordsPerFile", 1).json(path)  # one document a file
    m = S.match_jobs(order_baskets(spark, sf, "p_name"), sinks.read_jobs(spark, path), zero_pairs=True)
    return m.select("resume_id", "job_title", r6("ats_score").alias("ats_score"))


@register("noise_filter", f"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
SELECT doc_id, CAST(count(*) AS BIGINT) AS words, CAST(count(*) FILTER (WHERE {is_noise_skill_sql('word')}) AS BIGINT) AS noise
FROM w GROUP BY doc_id""")
def q_noise_filter(spark, sf):
    words = documents(spark, sf).select("doc_id", F.explode(F.split("text", " ", -1)).alias("word"))
    return words.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_if(is_noise_skill("word")).alias("noise"))
