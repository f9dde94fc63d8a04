"""op13's copies of fingerprints meet their homes in a shuffled join, whatever size Spark guesses."""

import re

import numpy as np

from cvlens.llm import anchor_simhash as S
from cvlens.session import ship_package


def test_copies_at_anchors_are_never_broadcast(spark):
    ship_package(spark)
    words = np.random.default_rng(5).integers(-2 ** 62, 2 ** 62, 60).tolist()
    near = [w ^ 5 for w in words[:20]]
    prints = spark.createDataFrame([(w,) for w in words + near], "fp long")
    for crowd in (S.CROWD, 0):
        found = S.links(prints, 2, crowd)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # only the list of crowded anchors, which leaves out or keeps rows, may be sent to all tasks
        assert not re.search(r"BroadcastHashJoin.*Inner", plan) and re.search(r"SortMergeJoin.*Inner", plan), plan
        if crowd:
            assert {(r["a"], r["b"]) for r in found.collect()} == {(min(p), max(p)) for p in zip(words, near)}
