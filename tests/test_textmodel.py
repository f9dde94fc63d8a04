"""The text models against a dense fit by Newton's method, and their table forms."""

import random
import re

import numpy as np
import pytest

from cvlens.operators import features as FE
from cvlens.operators import textmodel as T
from cvlens.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def rows(n=90, seed=3):
    rng = random.Random(seed)
    words = {"IT": "sql spark code data".split(), "HR": "people hiring policy data".split(), "ART": "paint colour stage".split()}
    out = []
    for i in range(n):
        label = rng.choice(list(words))
        text = " ".join(rng.choice(words[label] + ["and", "the", "of", "code", "people"]) for _ in range(rng.randint(1, 12)))
        out.append((f"r{i}", text, label, rng.sample(["SQL", "Excel", "Paint"], rng.randint(0, 2))))
    return out + [("r0", None, "IT", None), ("r0", "", "HR", []), ("null", "sql", None, ["SQL"])]


SCHEMA = "resume_id string, text string, category string, skills array<string>"


def dense(train, test, hybrid, c=1.0):
    """Probabilities of ``test`` under the optimum found by damped Newton steps on dense numbers."""
    tok = lambda t: re.findall(r"[^\W]{2,}", (t or "").lower())
    train = [r for r in train if r[2] is not None]
    terms = sorted({w for r in train for w in tok(r[1])})
    skills = sorted({s for r in train for s in r[3] or []})
    idf = {w: np.log((1 + len(train)) / (1 + sum(w in tok(r[1]) for r in train))) + 1 for w in terms}

    def matrix(rs):
        x = np.array([[tok(r[1]).count(w) * idf[w] for w in terms] for r in rs])
        x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)
        if hybrid:
            x = np.hstack([x, [[float(s in (r[3] or [])) for s in skills] for r in rs]])
        return np.hstack([x, np.ones((len(rs), 1))])
    x, labels = matrix(train), sorted({r[2] for r in train})
    y = np.array([[r[2] == z for z in labels] for r in train], float)
    n, d, k = len(x), x.shape[1], len(labels)
    pen = np.r_[np.full(d - 1, 1 / (c * n)), 0.0]
    w = np.zeros((d, k))

    def prob(x, w):
        z = x @ w
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)
    for _ in range(60):
        p = prob(x, w)
        g = x.T @ (p - y) / n + pen[:, None] * w
        h = np.zeros((d * k, d * k))
        for a in range(k):
            for b in range(k):
                s = p[:, a] * ((a == b) - p[:, b]) / n
                h[a * d:(a + 1) * d, b * d:(b + 1) * d] = x.T @ (s[:, None] * x) + (a == b) * np.diag(pen)
        w -= np.linalg.lstsq(h, g.T.ravel(), rcond=None)[0].reshape(k, d).T
    return labels, prob(matrix(test), w)


@pytest.mark.parametrize("hybrid", [False, True])
def test_probabilities_are_those_of_the_optimum(spark, hybrid):
    data = rows()
    test = rows(20, 7)[:20] + [("new", "unseen words only", "IT", ["Cobol"])]
    model = T.train(spark.createDataFrame(data, SCHEMA), "category", "text", "skills" if hybrid else None, tol=1e-7)
    assert model.gradient_size() <= 2e-7 and 0 < model.steps < 200
    labels, expected = dense(data, test, hybrid)
    numbered = spark.createDataFrame([(*r, i) for i, r in enumerate(test)], SCHEMA + ", at int")
    got = sorted(model.transform(numbered).collect(), key=lambda r: r["at"])
    assert model.labels == labels
    assert np.allclose([r["probability"] for r in got], expected, atol=2e-4)
    assert [r["prediction"] for r in got] == [labels[i] for i in expected.argmax(1)]
    long = model.predict_proba(spark.createDataFrame(test, SCHEMA)).collect()
    assert len(long) == len(test) * 3 and abs(sum(r["probability"] for r in long) - len(test)) < 1e-9


def test_the_gradient_tells_a_model_from_the_optimum(spark):
    model = T.train(spark.createDataFrame(rows(), SCHEMA))
    assert model.gradient_size() <= 1e-4
    model.intercept = [x + 0.5 * i for i, x in enumerate(model.intercept)]
    assert model.gradient_size() > 1e-2
    early = T.train(spark.createDataFrame(rows(), SCHEMA), max_iter=1)
    assert early.steps == 1 and early.gradient_size() > 1e-4


def test_coefficients_and_files(spark, tmp_path):
    model = T.train(spark.createDataFrame(rows(), SCHEMA), skills_col="skills")
    table = model.coefficients().collect()
    assert {(r["kind"], r["name"]) for r in table if r["kind"] != "term"} == {("intercept", None), ("skill", "SQL"), ("skill", "Excel"), ("skill", "Paint")}
    best = max((r for r in table if r["kind"] == "term"), key=lambda r: r["weight"])
    assert best["name"] in {"IT": ("sql", "spark"), "HR": ("hiring", "policy"), "ART": ("paint", "colour", "stage")}[best["class"]]
    model.save(str(tmp_path / "m"))
    df = spark.createDataFrame(rows(15, 9), SCHEMA)
    said = lambda m: sorted((r["resume_id"], r["text"] or "", tuple(round(x, 9) for x in r["probability"])) for r in m.transform(df).collect())
    assert said(T.load(spark, str(tmp_path / "m"))) == said(model)


def test_empty_training_rows(spark):
    with pytest.raises(ValueError):
        T.train(spark.createDataFrame([], SCHEMA))
    one = T.train(spark.createDataFrame([("a", "only one class", "IT", [])], SCHEMA))
    assert [r["prediction"] for r in one.transform(spark.createDataFrame(rows(3), SCHEMA)).collect()] == ["IT"] * 6


def test_skill_vectors_keep_rows_apart(spark):
    df = spark.createDataFrame([("a", ["y", "x", "x"]), ("a", None), ("b", ["z", "unknown"])], "resume_id string, normalized_skills array<string>")
    vocab = FE.vocabulary(spark.createDataFrame([(["x", "y", "z"],)], "normalized_skills array<string>"))
    got = sorted((r["resume_id"], r["feature_idx"], r["features"].toArray().tolist()) for r in FE.skill_vectors(df, vocab).collect())
    assert got == [("a", [], [0, 0, 0]), ("a", [0, 1], [1, 1, 0]), ("b", [2], [0, 0, 1])]


@pytest.mark.parametrize("hybrid", [False, True])
def test_the_driver_gets_nothing_that_grows_with_the_terms(spark, monkeypatch, hybrid):
    from pyspark.sql.classic.dataframe import DataFrame
    from cvlens.operators import regression
    monkeypatch.setattr(regression, "LEAST", 1 << 8)
    monkeypatch.setattr(regression, "COLUMNS", 1 << 8)
    rng = random.Random(5)
    data = [(f"r{i}", " ".join(f"{'ab'[i % 2]}{rng.randint(0, 4000)}" for _ in range(60)), "AB"[i % 2], [f"s{rng.randint(0, 900)}"]) for i in range(200)]
    fetched, collect = [], DataFrame.collect

    def counted(self):
        got = collect(self)
        fetched.append(sum(len(x) // 8 if isinstance(x, (bytes, bytearray)) else 1 for r in got for x in r))
        return got
    monkeypatch.setattr(DataFrame, "collect", counted)
    model = T.train(spark.createDataFrame(data, SCHEMA), skills_col="skills" if hybrid else None)
    assert model.n_terms > 4000 and model.gradient_size() <= 1.05e-4
    assert max(fetched) < 2000
