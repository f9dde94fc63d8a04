"""Steps that must not grow faster than their input: file scans, TF-IDF, K-means points."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cvlens.operators import blocks
from cvlens.operators import cluster as K
from cvlens.operators import features as FE
from cvlens.sources import files as FS


def _tree(root):
    for cat in ("a", "b"):
        (root / cat / "deeper").mkdir(parents=True)
        for i in range(400):
            (root / cat / f"{cat}{i}.txt").write_bytes(f"text {i}\r\nend".encode())
        for name, body in (("empty.txt", b""), (".hidden.txt", b"x"), ("_under.txt", b"x"), ("_k=v.txt", b"x"), ("sp ace%20.txt", b"x"),
                           ("UP.TXT", b"x"), ("no.md", b"x"), ("latin.txt", b"caf\xe9"), ("deeper/far.txt", b"x")):
            (root / cat / name).write_bytes(body)
    (root / "stray.txt").write_bytes(b"x")


def test_many_small_files_are_few_tasks_and_the_rows_of_sparks_reader(spark, tmp_path):
    _tree(tmp_path)
    most = 4 * spark.sparkContext.defaultParallelism
    for pattern in ("*.txt", "*.{txt,TXT,md}", "a?.t[xy]t", "*"):
        plain = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        archive = plain.load(f"{tmp_path}/*/").where(F.size(F.split("path", "/")) == len(str(tmp_path).split("/")) + 2)
        got = FS.list_archive(spark, str(tmp_path), pattern)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, archive.collect()))
        assert got.rdd.getNumPartitions() <= most
    flat = FS.read_flat(spark, f"{tmp_path}/a")
    assert flat.rdd.getNumPartitions() <= most
    rows = {r["resume_id"]: r for r in flat.collect()}
    assert len(rows) == 403 and rows["a7"]["resume_str"] == "text 7\nend" and rows["latin"]["resume_str"] == "café"
    assert rows["a7"]["source"] == f"file:{tmp_path}/a/a7.txt" and {r["category"] for r in rows.values()} == {"UNKNOWN"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FS.read_flat(spark, f"{tmp_path}/nowhere")


def test_tfidf_shuffles_texts_not_counts(spark):
    docs = [(1, "red red blue"), (2, "blue green"), (2, "green red x1"), (None, "blue sky"), (None, "sky"), (3, None), (4, "blue")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    merged = {}
    for i, t in docs:
        merged.setdefault(i, Counter()).update((t or "").split())
    freq = Counter(t for c in merged.values() for t in c)
    want = {}
    for i, c in merged.items():
        w = {t: k * (math.log((1 + len(docs)) / (1 + freq[t])) + 1) for t, k in c.items()}
        want |= {(i, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    for frequent in (1, 3, 100):
        out = FE.tfidf_long(df, frequent=frequent)
        assert {(r[0], r[1]): r[2] for r in out.collect()} == pytest.approx(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*doc_id#\d+L?, term#", plan) and "Window" not in plan


def test_kmeans_points_are_stored_in_blocks_and_scans_are_one_job(spark, monkeypatch):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(10 * c, 1, (1000, 3)) for c in range(3)])
    df = spark.createDataFrame([(x.tolist(),) for x in points], "v array<double>").repartition(2)
    kept = []
    monkeypatch.setattr(K, "stored", lambda df, name: kept.append(FE.stored(df, name)) or kept[-1])
    model = K.fit_kmeans(df, "v", k=3, n_init=4)
    assert kept[0].count() <= 2 * math.ceil(len(points) / K.SLICE)
    near = ((points[:, None] - model.centers[None]) ** 2).sum(2)
    assert model.cost == pytest.approx(near.min(1).sum())
    assert np.allclose(np.sort(model.centers.mean(1)), [0, 10, 20], atol=0.3)
    for bad in ([[1.0, 2.0], [1.0]], [[1.0], None]):
        with pytest.raises(Exception, match="point"):
            K.fit_kmeans(spark.createDataFrame([(b,) for b in bad], "v array<double>").coalesce(1), "v", k=2)
    rows = spark.range(100, numPartitions=5)
    total = lambda batches: np.array([float(sum(b.num_rows for b in batches)), 0.0, 1.0])
    assert blocks.summed(rows, total, 3).tolist() == blocks.summed(rows, total, 3, tasks=5).tolist() == [100.0, 0.0, 5.0]
