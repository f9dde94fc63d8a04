"""Steps that must not store or shuffle a text, or a number of many digits, more often than they need."""

import os
import random
import re

import numpy as np
import pytest

from cvlens.operators import features as FE
from cvlens.operators import regression
from cvlens.operators import resumes as R
from cvlens.operators import textmodel as T
from cvlens.session import ship_package
from test_textmodel import SCHEMA, dense, rows


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _size(df):
    return sum(os.path.getsize(re.sub("^file:/+", "/", f)) for f in df.inputFiles())


def test_training_rows_are_stored_in_few_bytes_and_texts_not_again(spark, monkeypatch):
    kept = {}
    for module in (T, regression):
        def spy(df, name, own=module.stored):
            kept[name] = own(df, name)
            return kept[name]
        monkeypatch.setattr(module, "stored", spy)
    rng = random.Random(1)
    data = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(200)), "AB"[i % 2]) for i in range(1500)]
    df = spark.createDataFrame(data, "_row long, text string, category string").coalesce(1)
    T.train(df, max_iter=1, row_col="_row")
    entries = sum(len(set(re.findall(r"\w{2,}", t))) for _, t, _ in data)
    assert not {"model-rows", "term-counts"} & set(kept)
    assert _size(kept["packed-rows"]) < 4 * entries and _size(kept["training-rows"]) < 6 * entries


def test_counts_of_terms_are_not_shuffled_by_term(spark):
    df = spark.createDataFrame([(1, "red red blue"), (2, "blue green"), (3, None)], "_row long, text string")
    vocab = FE.text_vocabulary(df, 3)
    near, far = FE.term_entries(df, FE.common_terms(vocab), vocab, "_row")
    assert sorted((r["_row"], r["term"], r["tf"]) for r in near.collect()) == [(1, "blue", 1), (1, "red", 2), (2, "blue", 1), (2, "green", 1)]
    assert far.collect() == []
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*_row#\d+L?, term#", plan)


@pytest.mark.parametrize("hybrid", [False, True])
def test_rare_terms_take_part_like_common_ones(spark, monkeypatch, hybrid):
    monkeypatch.setattr(FE, "FREQUENT", 3)
    data, test = rows(), rows(20, 7)[:20]
    model = T.train(spark.createDataFrame(data, SCHEMA), "category", "text", "skills" if hybrid else None, tol=1e-7)
    assert model.gradient_size() <= 2e-7
    numbered = spark.createDataFrame([(*r, i) for i, r in enumerate(test)], SCHEMA + ", at long")
    got = sorted(model.transform(numbered, "at").collect(), key=lambda r: r["at"])
    assert np.allclose([r["probability"] for r in got], dense(data, test, hybrid)[1], atol=2e-4)


def test_without_texts_no_text_but_the_told_one_is_stored(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(R, "stored", lambda df, name, own=R.stored: kept.setdefault(name, own(df, name)))
    aliases = spark.createDataFrame([("py", "python"), ("sql", "sql")], "alias string, canonical string")
    given = spark.createDataFrame([("a", "IT", "SKILLS: Py, Excel\nEXPERIENCE: sql and python\nEDUCATION: x"), ("a", "IT", None), ("b", "HR", "sql"), (None, "HR", "py")],
                                  "resume_id string, category string, resume_str string")
    columns = ["resume_id", "job_category", "normalized_skills", "skills", "_error"]
    whole = sorted(map(str, R.structure_resumes(given, aliases).select(columns).collect()))
    kept.clear()
    slim = R.structure_resumes(given, aliases, keep_texts=False)
    assert "sections" not in slim.columns and sorted(map(str, slim.select(columns).collect())) == whole
    texts = {"resume_str", "clean", "_told", *(f"sec_{n}" for n in R.SECTION_NAMES)} & set(kept["sections"].columns)
    assert texts == {"_told"}


def test_silhouette_blocks_grow_before_they_become_many():
    from cvlens.operators import cluster as K
    size = K.BLOCK_BYTES
    assert [K._block_count(x * size, size) for x in (0, 1, 5, 12, 24, 48, 100)] == [1, 1, 5, 12, 12, 12, 25]
