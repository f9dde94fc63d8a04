"""Exact cases (see FIXTURES.md section 3) as PySpark unit tests."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cvlens.functions.sections import add_sections
from cvlens.functions.text import clean_text
from cvlens.operators import cluster as K
from cvlens.operators import metrics as M
from cvlens.operators import mining
from cvlens.operators import scoring as S
from cvlens.operators import validation as V
from cvlens.operators.features import vocabulary
from cvlens.operators.skills import normalize_skills
from cvlens.sources.aliases import alias_frame


def one_col(spark, values, name="t", typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {typ}")


def collect_col(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


# ---- text --------------------------------------------------------------------

def _py_clean(raw):
    """Plain-Python statement of the cleaning rules (test oracle)."""
    if not raw:
        return ""
    t = re.sub(r'[^a-zA-Z0-9\s.,!?;:\-\'"()\[\]/@]+', " ", raw)
    t = re.sub(r"\n\s*\n+", "\n\n", t)
    t = re.sub(r"[ \t]+", " ", t)
    return "\n".join(x.strip() for x in t.split("\n")).strip()


def test_clean_text_blank(spark):
    df = one_col(spark, ["", "   ", "\n\n", None]).select("i", clean_text("t").alias("c"))
    assert collect_col(df, "c") == ["", "", "", ""]


def test_clean_text_random_matches_python(spark):
    rng = random.Random(7)
    alphabet = list("ab Z9.,-'\"@/()[]#+é\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　ü!?;:")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    got = collect_col(one_col(spark, texts).select("i", clean_text("t").alias("c")), "c")
    assert got == [_py_clean(t) for t in texts]


# ---- sections ------------------------------------------------------------------

def sections_of(spark, texts):
    df = add_sections(one_col(spark, texts), "t")
    return [(r.skills, r.experience, r.education, r.projects) for r in df.orderBy("i").collect()]


def test_sections_absent(spark):
    assert sections_of(spark, ["nothing here at all"]) == [("", "", "", "")]


def test_sections_boundaries(spark):
    got = sections_of(spark, ["skilled in Go; Experience: x", "EducationTechnical Skills a Projects b",
                              "SKILLS: Python, SQL\nEXPERIENCE\n\nEDUCATION: BSc"])
    assert got[0][:2] == ("ed in Go;", ": x")
    assert got[1][2] == "Technical Skills a"
    assert got[2][0] == ": Python, SQL" and got[2][1] == ""


# ---- normalisation ---------------------------------------------------------------

def normalize(spark, skills, aliases=None, cutoff=85.0):
    df = spark.createDataFrame([("r1", skills)], "resume_id string, skills array<string>")
    out = normalize_skills(df, alias_frame(spark, aliases), "skills", cutoff)
    return out.first()["normalized_skills"]


def test_fuzzy_and_exact(spark):
    assert normalize(spark, ["Pyton"], {"python": "Python"}) == ["Python"]
    assert normalize(spark, ["Machine Lerning"], {"ml": "Machine Learning"}) == ["Machine Learning"]
    assert normalize(spark, ["python", "Python", "PYTHON", "JS", "  "]) == ["python", "Python", "python",
                                                                          "JavaScript", ""]


def lcs_length(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    return m[-1][-1]


def similarity(a, b):
    total = len(a) + len(b)
    return 1.0 - (total - 2 * lcs_length(a, b)) / total if total else 1.0


def test_indel_ratio(spark):
    from cvlens.functions.fuzzy import indel_similarity
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcß😀") for _ in range(rng.randint(0, 9)))
    pairs = [("Pythn", "Python"), ("python", "Python"), ("", ""), ("a", ""), ("x" * 80, "y" + "x" * 79)] + [(word(), word()) for _ in range(300)]
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)] + [(None, "a", -1)], "a string, b string, i int")
    out = df.select("i", indel_similarity(F.col("a"), F.col("b")).alias("s"))
    got = {r["i"]: r["s"] for r in out.collect()}
    assert math.isclose(got[0] * 100, 90.9090909, rel_tol=1e-6) and math.isclose(got[1] * 100, 83.3333333, rel_tol=1e-6)
    assert got.pop(-1) is None and all(math.isclose(got[i], similarity(*p)) for i, p in enumerate(pairs))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("Pythn", "") or "ArrowEvalPython" not in plan


# ---- mining ----------------------------------------------------------------------

def test_clean_transaction(spark):
    items = [None, " Rust ", "RUST", "phone", "Address ", "a.b@c.dev", "see www.site.io", "http://x", "+49 30 1234567",
             "gleam.com tools", "Prolog", "rust", "", "prolog"]
    df = spark.createDataFrame([("r", items), ("r", ["Zig"]), ("s", ["city"])], "resume_id string, s array<string>")
    assert df.select(mining.clean_transaction(F.col("s")).alias("c")).first()["c"] == ["Rust", "see www.site.io", "Prolog"]
    # rows that share an id stay apart, and what is all noise goes
    assert sorted(tuple(r["items"]) for r in mining.transactions(df, "s").collect()) == [("Rust", "see www.site.io", "Prolog"), ("Zig",)]


def test_effective_support():
    assert mining.effective_min_support(0.1, 5) == 0.4
    assert mining.effective_min_support(0.1, 25) == 0.1


def test_itemsets_and_multi_item_consequents(spark):
    baskets = [["Python", "SQL", "Java"], ["Python", "SQL"], ["Python", "Java", "SQL"], ["Go", "SQL", "Java"]]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(baskets)], "resume_id string, normalized_skills array<string>")
    res = mining.mine_associations(df, 0.5, 0.5)
    sets = {"|".join(r["items"]): r["support"] for r in res.itemsets.collect()}
    assert sets["Python"] == 0.75
    rules = res.rules.collect()
    assert any(len(r["consequents"]) == 2 for r in rules)
    with pytest.raises(ValueError):
        mining.mine_associations(df, 0.0, 0.5)


# ---- metrics -----------------------------------------------------------------------

def preds(spark, y, p):
    return spark.createDataFrame(list(zip(y, p)), "label string, prediction string")


def test_per_class_f1(spark):
    f = {r["label"]: r["f1"] for r in M.per_class_f1(preds(spark, "AABB", "AABA")).collect()}
    assert math.isclose(f["A"], 0.8) and math.isclose(f["B"], 2 / 3)


def test_unseen_prediction(spark):
    s = M.classification_summary(preds(spark, "A", "B")).first()
    assert s["accuracy"] == 0.0 and s["macro_f1"] == 0.0


def test_fairness_flags_c(spark):
    f = M.fairness(preds(spark, "AAABBBCCC", "AAABBBABA"), ["A", "B", "C"])
    assert [r["category"] for r in f.where("flagged").collect()] == ["C"]


def test_cross_source_threshold(spark):
    y = list("ABCABCABCA")
    rows = [(t, t, "csv") for t in y] + [(t, p, "pdf") for t, p in zip(y, list("ABCABCABCB"))]
    df = spark.createDataFrame(rows, "label string, prediction string, source string")
    r = M.cross_source_validation(df, threshold=0.1).first()
    assert math.isclose(r["accuracy_difference"], 0.1) and r["consistent_performance"]


def test_extraction_edges(spark):
    df = spark.createDataFrame([("", "", [], []), ("a", "a", ["x"], [])],
                               "csv_text string, pdf_text string, csv_skills array<string>, pdf_skills array<string>")
    out = df.select(V.length_similarity("csv_text", "pdf_text").alias("s"),
                    V.skill_jaccard("csv_skills", "pdf_skills").alias("o")).collect()
    assert (out[0]["s"], out[0]["o"]) == (1.0, 1.0) and out[1]["o"] == 0.0


def test_ats(spark):
    df = spark.createDataFrame([(["Python", "Java"], ["python", "java", "c++"]), (["a", "a"], ["A", "a"]),
                                ([], ["x"])], "r array<string>, j array<string>")
    got = [r["s"] for r in df.select(S.ats_score("r", "j").alias("s")).collect()]
    assert math.isclose(got[0], 200 / 3) and got[1] == 100.0 and got[2] == 0.0


# ---- features and clusters ---------------------------------------------------------

def test_vocabulary_sorted(spark):
    df = spark.createDataFrame([(["b", "a"],), (["c", "a"],)], "normalized_skills array<string>")
    assert [(r["skill"], r["idx"]) for r in vocabulary(df).orderBy("idx").collect()] == [("a", 0), ("b", 1), ("c", 2)]


def test_silhouette_single_cluster_and_exact(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0], 0) for i in range(4)], "id long, v array<double>, c int")
    assert K.silhouette(df, "id", "v", "c").first()["silhouette"] == 0.0
    pts = [(0, [0.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [5.0, 0.0], 1), (3, [6.0, 1.0], 1), (4, [9.0, 9.0], 2)]
    df = spark.createDataFrame(pts, "id long, v array<double>, c int")
    got = K.silhouette(df, "id", "v", "c", block_bytes=32).first()["silhouette"]
    import numpy as np
    X = np.array([p[1] for p in pts]); lab = np.array([p[2] for p in pts])
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)); s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0); continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert math.isclose(got, float(np.mean(s)), rel_tol=1e-9)


def test_cluster_profiles(spark):
    rows = [(0, ["welding", "brazing", "Summary"]), (0, ["Welding", "brazing", "welding"]), (0, ["welding", None]), (0, None),
            (1, ["glass  cutting", "etching"]), (1, ["etching", "email"]), (2, [])]
    df = spark.createDataFrame(rows, "cluster int, normalized_skills array<string>")
    p = K.cluster_profiles(df, top_n=3)
    got = {c: [(r["skill"], r["weight"]) for r in p.where(f"cluster = {c}").orderBy("rank").collect()] for c in (0, 1, 2)}
    assert got == {0: [("welding", 0.75), ("brazing", 0.5), ("glass cutting", 0.0)],
                   1: [("etching", 1.0), ("glass cutting", 0.5), ("welding", 0.0)],
                   2: [("welding", 0.0), ("glass cutting", 0.0), ("etching", 0.0)]}


def test_required_columns(spark, tmp_path):
    from cvlens.sources.files import read_resume_csv
    p = tmp_path / "bad.csv"
    p.write_text("ID,Resume_str,Category\n1,x,A\n")
    with pytest.raises(ValueError):
        read_resume_csv(spark, str(p))


def test_streaming_ingest(spark, tmp_path):
    from cvlens.streaming import start_ingest
    root = tmp_path / "archive"
    (root / "IT").mkdir(parents=True)
    (root / "IT" / "r1.txt").write_text("SKILLS: Python, SQL\nEXPERIENCE: built spark jobs")
    (root / "HR").mkdir()
    (root / "HR" / "r2.txt").write_text("Skills: Excel; Word\nEducation: BA")
    q = start_ingest(spark, str(root), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.processAllAvailable()
    q.stop()
    rows = {r["resume_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["r1"]["category"] == "IT" and rows["r1"]["explicit_skills"] == ["Python", "SQL"]
    assert rows["r2"]["explicit_skills"] == ["Excel", "Word"] and "spark" in rows["r1"]["implicit_skills"]


# ---- guards, sources and candidates --------------------------------------------------

def test_silhouette_takes_string_ids_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors
    pts = [("a", [0.0, 1.0], 0), ("b", [0.0, 2.0], 0), ("c", [4.0, 0.0], 1), ("d", [5.0, 0.0], 1), ("d", [9.0, 0.0], 1)]
    dense = spark.createDataFrame(pts, "id string, v array<double>, c int")
    sparse = spark.createDataFrame([(i, Vectors.sparse(2, [(k, x) for k, x in enumerate(v) if x]), c) for i, v, c in pts], ["id", "v", "c"])
    whole, blocked, other = (K.silhouette(df, "id", "v", "c", block_bytes=b).first()["silhouette"]
                             for df, b in ((dense, 1 << 20), (dense, 16), (sparse, 16)))
    assert math.isclose(whole, blocked, rel_tol=1e-12) and math.isclose(whole, other, rel_tol=1e-12)


def test_normalize_keeps_rows_of_one_id_apart(spark):
    df = spark.createDataFrame([("r", ["js", "sql"]), ("r", ["excel"]), ("r", None), ("q", [])], "resume_id string, skills array<string>")
    out = normalize_skills(df, alias_frame(spark), "skills")
    assert sorted((r["resume_id"], tuple(r["normalized_skills"])) for r in out.collect()) == [
        ("q", ()), ("r", ()), ("r", ("JavaScript", "SQL")), ("r", ("Microsoft Excel",))]


@pytest.mark.parametrize("cutoff", [60.0, 85.0, 100.0])
def test_fuzzy_candidates_lose_no_pair(spark, cutoff):
    from cvlens.operators.skills import fuzzy_candidates
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
    skills, names = {word() for _ in range(120)}, {word() for _ in range(80)}
    got = fuzzy_candidates(spark.createDataFrame([(s,) for s in skills], "skill string"),
                           spark.createDataFrame([(n,) for n in names], "canonical string"), cutoff)
    pairs = {tuple(r) for r in got.collect()}
    assert {(s, n) for s in skills for n in names if similarity(s, n) >= cutoff / 100} <= pairs
    if cutoff > 80:
        assert len(pairs) < 0.05 * len(skills) * len(names)


def brute_terms(text, terms):
    """Leftmost, longest, no word character beside an occurrence, without overlap."""
    text, at, out = text.lower(), 0, []
    word = lambda c: c.isascii() and (c.isalnum() or c == "_")
    free = lambda i: not (0 <= i < len(text)) or not word(text[i])
    while at < len(text):
        hit = max((t for t in terms if text.startswith(t, at) and free(at - 1) and free(at + len(t))), key=len, default=None)
        if hit and hit not in out:
            out.append(hit)
        at += len(hit) if hit else 1
    return out


def test_terms_are_found_as_by_hand(spark):
    from cvlens.operators.skills import dictionary_terms, find_terms
    names = [".NET", "c++", "C#", "c", "java", " JavaScript ", "machine learning", "machine learning ops", "learning", "ci/cd", "a b c", "++", "é"]
    rng = random.Random(12)
    texts = ["uses .NET and c++, java. not javascripts", "asp.net c# c java8", "machine learning opsx machine learning ops learning", "a b c d a b", "", None,
             "C++ ++ +++ c é été", "ci/cd/ci"]
    texts += ["".join(rng.choice(["c", "+", "+", "#", " ", "java", "machine", "learning", " ops", "/", "a b ", ".net", "é", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    terms = dictionary_terms(spark.createDataFrame([(n, n.upper()) for n in names], "alias string, canonical string"))
    got = {r["i"]: r["implicit_skills"] for r in find_terms(one_col(spark, texts), terms, "i", "t").collect()}
    low = {n.strip().lower() for n in names}
    assert {i: got.get(i, []) for i in range(len(texts))} == {i: brute_terms(t or "", low) for i, t in enumerate(texts)}
    assert find_terms(one_col(spark, texts), terms.limit(0), "i", "t").collect() == []


def test_tokens_keep_accents(spark):
    from cvlens.operators.features import tokens
    out = one_col(spark, ["Ingénieur à l'École naïve x_1 9", None]).select("i", tokens("t").alias("w"))
    assert collect_col(out, "w") == [["ingénieur", "école", "naïve", "x_1"], []]


def test_split_is_exact_and_repeatable(spark):
    from cvlens.operators.features import split_train_test
    for n, share, k in ((1, 0.2, 1), (10, 0.2, 2), (333, 0.3, 100)):
        df = spark.range(n).selectExpr("cast(id as string) resume_id")
        a, b = (sorted(r["resume_id"] for r in split_train_test(x, test_size=share).where("split = 'test'").collect())
                for x in (df, df.repartition(3)))
        assert a == b and len(a) == k
    with pytest.raises(ValueError):
        split_train_test(df, test_size=1.0)


def test_guards(spark):
    df = spark.createDataFrame([(0, "r", ["a"], [1.0])], "cluster int, resume_id string, normalized_skills array<string>, features array<double>")
    for bad in (lambda: K.cluster_profiles(df, top_n=0), lambda: K.fit_kmeans(df, k=1), lambda: K.fit_kmeans(df, k=2),
                lambda: K.fit_kmeans(df.limit(0), k=2), lambda: vocabulary(df.limit(0)),
                lambda: mining.mine_associations(df.limit(0)), lambda: mining.mine_associations(df, 1.5, 0.5),
                lambda: V.require_overlap(V.unmatched_counts(df, df.limit(0), "cluster"))):
        with pytest.raises(ValueError):
            bad()


def test_kmeans_starts_share_their_scans(spark):
    rng = random.Random(2)
    true = [(0, 0), (10, 0), (0, 10), (10, 10)]
    pts = [(i, [c[0] + rng.gauss(0, 0.5), c[1] + rng.gauss(0, 0.5)]) for i, c in enumerate(true * 30)]
    df = spark.createDataFrame(pts, "i int, v array<double>").repartition(3)
    model = K.fit_kmeans(df, "v", k=4, n_init=5, seed=1)
    got = {r["i"]: r["cluster"] for r in model.transform(df).collect()}
    assert len(model.costs) == len(model.rounds) == 5 and model.cost == min(model.costs)
    groups = {}
    for i, _ in pts:
        groups.setdefault(i % 4, set()).add(got[i])
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 4
    cost = 0.0
    for c in range(4):
        own = [v for i, v in pts if got[i] == c]
        mean = [sum(x) / len(own) for x in zip(*own)]
        assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(model.centers[c], mean))
        cost += sum((x - m) ** 2 for v in own for x, m in zip(v, mean))
    assert math.isclose(cost, model.cost, rel_tol=1e-9)
    assert K.fit_kmeans(df.repartition(1).sortWithinPartitions("i"), "v", k=4, n_init=2).cost <= model.cost * 1.0001


def test_kmeans_of_index_lists(spark):
    """Lists of columns that are 1 give what the same points give as dense arrays; equal points leave centres empty."""
    rng = random.Random(5)
    rows = [(i, sorted(rng.sample(range(12), rng.randint(0, 4)))) for i in range(60)]
    df = spark.createDataFrame([(i, x, [float(j in x) for j in range(12)]) for i, x in rows], "i int, x array<int>, v array<double>").coalesce(1)
    a, b = K.fit_kmeans(df, k=3, n_init=3, index_col="x", size=12), K.fit_kmeans(df, "v", k=3, n_init=3)
    assert all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(a.costs, b.costs))
    assert [tuple(r) for r in a.transform(df).select("i", "cluster").collect()] == [tuple(r) for r in b.transform(df).select("i", "cluster").collect()]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "i int, v array<double>")
    model = K.fit_kmeans(same, "v", k=3, n_init=2)
    assert model.cost == 0.0 and len({r["cluster"] for r in model.transform(same).collect()}) == 1


def test_row_index_follows_the_files(spark, tmp_path):
    from cvlens.sources.files import read_resume_csv
    head, expected = "ID,Resume_str,Resume_html,Category\n", []
    for f in range(9):  # of different sizes, so that scans take them in another order than their names'
        own = [f"{f}-{i}" for i in range((f * 7) % 5)]
        (tmp_path / f"part-{f}.csv").write_text(head + "".join(f'{x},"line\n{"y" * 50 * f}",,IT\n' for x in own))
        expected += own
    got = read_resume_csv(spark, str(tmp_path), with_row_index=True).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["resume_id"]) for r in got] == list(enumerate(expected))
    assert all(r["source"].endswith(f":row_{i}") for i, r in enumerate(got))


def test_faults_go_through_the_pipeline(spark):
    from cvlens.operators import resumes as R
    rows = [("a", "IT", "Skills: js", "f/a.txt", None), ("b", "IT", None, "f/b.pdf", "no decoder for .pdf"), ("c", "HR", None, "f/c.txt", None),
            (None, "HR", "Skills: sql", "f/d.txt", None), ("e", "HR", "text beside an error", "f/e.txt", "binary content"), ("f", "HR", "", "f/f.txt", None)]
    df = spark.createDataFrame(rows, "resume_id string, category string, resume_str string, source string, _error string")
    good, bad = R.split_faults(R.structure_resumes(df, alias_frame(spark)))
    assert {(r["resume_id"], tuple(r["normalized_skills"])) for r in good.collect()} == {("a", ("JavaScript",)), ("f", ())}
    assert {(r["file_path"], r["error"]) for r in bad.collect()} == {
        ("f/b.pdf", "no decoder for .pdf"), ("f/c.txt", "no text"), ("f/d.txt", "no id"), ("f/e.txt", "binary content")}
    assert "_error" not in good.columns and good.where("sections.raw_text IS NULL").count() == 0


def test_job_hits_and_zero_pairs(spark):
    res = spark.createDataFrame([("r", "IT", ["Python", "sql", None]), ("r", "IT", ["Excel"]), ("q", "HR", ["python"]), ("n", "IT", None)],
                                "resume_id string, category string, normalized_skills array<string>")
    jobs = spark.createDataFrame([("dev", "IT", ["PYTHON", "python", "Go"]), ("dev", "IT", ["sql"]), ("empty", "IT", []), ("hr", "HR", ["Word"])],
                                 "job_title string, job_category string, required_skills array<string>")
    hits = sorted(tuple(r) for r in S.match_jobs(res, jobs).collect())
    assert hits == [("r", "dev", 50.0), ("r", "dev", 100.0)]
    both = sorted(tuple(r) for r in S.match_jobs(res, jobs, zero_pairs=True).collect())
    assert len(both) == 3 * 3 + 1 and [p for p in both if p[2]] == hits


def test_alias_lines(spark, tmp_path):
    from cvlens.sources.aliases import load_alias_lines, write_alias_lines
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.json").write_text('{"ts": "TypeScript", "n": 5}\n\n{"aliases": {"go": "Golang"}, "other": "no"}\n')
    (tmp_path / "d" / "2.json").write_text('{"go": "Go", "x": null}\n')
    want = {("ts", "TypeScript"), ("go", "Go")}
    got = load_alias_lines(spark, str(tmp_path / "d"))
    assert {tuple(r) for r in got.collect()} == want
    write_alias_lines(got, str(tmp_path / "again"))
    assert {tuple(r) for r in load_alias_lines(spark, str(tmp_path / "again")).collect()} == want
    assert load_alias_lines(spark, str(tmp_path / "none"), missing_ok=True).collect() == []
    (tmp_path / "bad").write_text('{"ts": ')
    with pytest.raises(Exception):
        load_alias_lines(spark, str(tmp_path / "bad")).collect()


def test_label_names_of_a_superset(spark):
    got = M.resolve_label_names(preds(spark, "AB", "AA"), ["B", "A", "Z"]).collect()
    assert {r["name"]: r["label"] for r in got} == {"A": "A", "B": "B"} or {r["name"] for r in got} == {"A", "B", "Z"}


def test_alias_files(spark, tmp_path):
    from cvlens.sources.aliases import load_alias_dictionary
    load = lambda name, **k: {tuple(r) for r in load_alias_dictionary(spark, str(tmp_path / name), **k).collect()}
    (tmp_path / "flat.json").write_text('{"ts": "TypeScript",\n "n": 5, "x": null}')
    (tmp_path / "nested.json").write_text('{"aliases": {"go": "Golang"}, "other": "no"}')
    (tmp_path / "broken.json").write_text('{"ts": "TypeScript"')
    assert load("flat.json") == {("ts", "TypeScript")} and load("nested.json") == {("go", "Golang")}
    assert load("none.json", missing_ok=True) == set()
    for name in ("broken.json", "none.json"):
        with pytest.raises(Exception):
            load(name)


def test_files_decode_extension_and_quarantine(spark, tmp_path):
    from cvlens.sources import files as FS
    for name, body in (("IT/a.txt", "Größe\r\nx".encode("latin-1")), ("IT/b.TXT", "Größe".encode()), ("IT/c.md", b"x"), ("IT/sub/d.txt", b"x"),
                       ("HR/e.txt", b"a\0b"), ("HR/f.pdf", b"%PDF"), ("stray.txt", b"x")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body)
    got = {(r["resume_id"], r["category"], r["resume_str"]) for r in FS.read_archive(spark, str(tmp_path), "*.{txt,TXT,md}").collect()}
    assert got == {("a", "IT", "Größe\nx"), ("b", "IT", "Größe"), ("e", "HR", "a\0b")}
    rows = FS.quarantine(FS.list_archive(spark, str(tmp_path), "*"))
    assert {(r["resume_id"], r["_error"]) for r in rows.collect()} == {
        ("a", None), ("b", None), ("c", "extension not accepted"), ("e", "binary content"), ("f", "no decoder for .pdf")}
    assert tuple(FS.quarantine_counts(rows).first()) == (2, 3, 5)


def test_csv_to_features(spark, tmp_path):
    from cvlens.operators import resumes as R
    from cvlens.sources.files import read_resume_csv
    (tmp_path / "r.csv").write_text('ID,Resume_str,Resume_html,Category\n1,"Skills: js; Excel\nExperience: sql work",,IT\n2,"Skills: Excel",,\n')
    done = R.structure_resumes(read_resume_csv(spark, str(tmp_path / "r.csv"), with_row_index=True), alias_frame(spark))
    rows = {r["resume_id"]: r for r in done.collect()}
    assert rows["1"]["normalized_skills"] == ["JavaScript", "Microsoft Excel", "SQL"] and rows["2"]["job_category"] == "UNKNOWN"
    assert [rows[i]["metadata"]["file_path"].rpartition(":")[2] for i in "12"] == ["row_0", "row_1"]
    assert rows["1"]["metadata"]["processed_date"][:2] == "20"
    vectors, vocab = R.resume_features(done)
    assert [r["skill"] for r in vocab.orderBy("idx").collect()] == ["JavaScript", "Microsoft Excel", "SQL"]
    assert {r["resume_id"]: r["features"].toArray().tolist() for r in vectors.collect()} == {"1": [1, 1, 1], "2": [0, 1, 0]}


def test_empty_report(spark):
    assert M.combined_report(spark).columns == []


def test_quick_patterns_match_the_same(spark):
    import random

    from cvlens.functions import sections as SE
    from cvlens.functions import text as TX
    draw = random.Random(4)
    bits = list("aZ9 .,;\n\t\r\x0b\x85\xa0 é_{~!") + ["　", " ", "technical skills", "SKILL", "Portfolio", "workexperience", " \n "]
    df = spark.createDataFrame([("".join(draw.choice(bits) for _ in range(draw.randint(0, 50))),) for _ in range(600)], "t string")
    for quick, plain in ((TX.NO_DISALLOWED_START + TX.DISALLOWED_RUN, TX.DISALLOWED_RUN), (TX.NO_EDGE_START + TX.LINE_EDGES, TX.LINE_EDGES)):
        assert quick != plain and df.where(F.regexp_replace("t", quick, "#") != F.regexp_replace("t", plain, "#")).isEmpty()
    for p in [p for ps in SE.DEFAULT_SECTION_PATTERNS.values() for p in ps] + [r"(?i)skills:", r"(?i)competencies:"]:
        assert SE._quick(p) != p
        assert df.where(F.to_json(F.split("t", SE._quick(p), -1)) != F.to_json(F.split("t", p, -1))).isEmpty()
    assert [SE._quick(p) for p in (r"(?i)s?kill", r"(?i)(a|)", r"skills", r"(?i)\d+")] == [r"(?i)s?kill", r"(?i)(a|)", r"skills", r"(?i)\d+"]


def test_spans_are_built_only_where_a_term_may_begin(spark, monkeypatch):
    from cvlens.operators import skills as SK
    texts = spark.createDataFrame([(1, "the sql server, rest-api and c++ (vue.js)"), (2, "nothing here"), (3, None), (4, "REST")], "row long, text string")
    terms = SK.dictionary_terms(spark.createDataFrame([("sql", "SQL"), ("rest-api", "REST"), ("c++", "C++"), ("vue.js", "Vue.js")], "alias string, canonical string"))
    expected = [(1, ["sql", "rest-api", "c++", "vue.js"]), (4, ["rest"])]
    assert sorted((r[0], r[1]) for r in SK.find_terms(texts, terms, "row", "text").collect()) == expected
    monkeypatch.setattr(SK, "FIRSTS", 1)  # a dictionary too large for the hash values: no position is left out
    assert sorted((r[0], r[1]) for r in SK.find_terms(texts, terms, "row", "text").collect()) == expected
