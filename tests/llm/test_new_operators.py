"""Ptolemaic clusters, importance resampling and anchor-point SimHash against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from cvlens.llm import anchor_simhash, importance, ptolemy_clusters
from cvlens.session import ship_package
from test_text_operators import SCHEMA, prose, stored

VECTORS = "vec_id long, embedding array<double>, cluster string, distance string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# ---- centroid clustering ---------------------------------------------------

def brute_clusters(rows, k, rounds, dims, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(repr((i, j, d, inertia[j], sum(inertia.values()), sha[j])) for i, d, j in found)


def vector_rows(n, dims, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(n)]
    odd = [(9000, None), (9001, [None] * dims), (9002, [float("nan")] * dims), (9003, [float("inf")] * dims), (9004, [1.0]), (9005, [])]
    same = [(9010 + i, rows[0][1]) for i in range(n // 2)] + [rows[1], rows[1], (None, rows[2][1]), (9100, [0.0] * dims)]
    return rows + odd + same


def test_clusters_are_those_of_lloyd_in_integers(spark):
    rows = vector_rows(150, 8)
    df = stored(spark, [(*r, "x", "y") for r in rows], VECTORS)
    got = ptolemy_clusters.cluster_digests(df, k=7, rounds=4, dims=8).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_clusters(rows, 7, 4, 8)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.001, 3.0])]])
def test_clusters_of_few(spark, rows):
    df = stored(spark, [(*r, "x", "y") for r in rows], VECTORS, parts=1)
    got = ptolemy_clusters.cluster_digests(df, k=5, rounds=2, dims=2).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_clusters(rows, 5, 2, 2)


def test_components_too_large_for_a_long_take_no_part(spark):
    df = stored(spark, [(1, [1e300, 0.0], "", ""), (2, [1.0, 0.0], "", "")], VECTORS)
    assert [r.vec_id for r in ptolemy_clusters.cluster_digests(df, k=2, rounds=1, dims=2).collect()] == [2]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    centres = rng.integers(-200, 200, (12, 16))
    x = centres[rng.integers(0, 12, 800)] + rng.integers(-9, 9, (800, 16))
    pivots = ptolemy_clusters.choose_pivots(x[:100])
    to = ptolemy_clusters.squared(x, pivots)
    exact = ptolemy_clusters.squared(x, centres)
    assert (ptolemy_clusters.lower_bounds(to, ptolemy_clusters.squared(centres, pivots), pivots) <= exact).all()
    who, best, computed = ptolemy_clusters.assign(x, to, centres, pivots)
    assert (who == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert computed < exact.size / 2


def test_ties_go_to_the_smaller_centroid():
    x, c = np.array([[0, 0], [2, 0], [5, 5]]), np.array([[1, 0], [-1, 0], [1, 0], [3, 0]])
    pivots = np.array([[7, 7], [0, 9], [-4, 2]])
    who, best, _ = ptolemy_clusters.assign(x, ptolemy_clusters.squared(x, pivots), c, pivots)
    assert who.tolist() == [0, 0, 3] and best.tolist() == [1, 1, 29]


# ---- importance resampling -------------------------------------------------

def brute_resample(rows, target, percent=10, min_words=20, max_n=1, buckets=10_000):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        n_words, own = features(text)
        weight = sum(gain(bucket(f)) for f in own)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, n_words])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted(repr(tuple(r[:5])) for r in out)


def text_rows(n=120, seed=2):
    rng = random.Random(seed)
    odd = [None, "", "   ", "A-b_c 12x", "ÀB àb", "\x00x\x7fy\x85z", "x" * 5000, "The, the; THE " * 4000, "日本 語 テスト"]
    return list(enumerate(odd + [prose(rng, rng.randint(1, 120)) for _ in range(n)]))


@pytest.mark.parametrize("max_n", [1, 3])
def test_resampling_is_that_of_the_formula(spark, max_n):
    rows = text_rows() + [(5, "rare words " * 30), (5, "rare words " * 30), (None, "no name " * 15)] + [(7000 + i, "hot copy " * 11) for i in range(60)]
    target = [t for _, t in text_rows(10, 3)] + ["the the", None]
    docs = stored(spark, [(i, t, 1) for i, t in rows], SCHEMA + ", weight int")
    got = importance.resample(docs, stored(spark, [(t,) for t in target], "text string"), percent=25, max_n=max_n).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_resample(rows, target, 25, max_n=max_n)


def test_resampling_nothing(spark):
    none = stored(spark, [], "text string")
    assert importance.resample(stored(spark, []), none).collect() == []
    got = importance.resample(stored(spark, [(1, "word " * 20)]), none, percent=100).collect()
    assert [(r.n_features, r["rank"]) for r in got] == [(20, 1)]


def test_chained_hashes_are_those_of_the_joined_words():
    words = "a bc ß def".encode().split()
    got = list(importance.feature_hashes(words, 3))
    assert got == [[zlib.crc32(b" ".join(words[i:i + n])) for i in range(5 - n)] for n in (1, 2, 3)]


# ---- SimHash ---------------------------------------------------------------

def brute_print(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, threshold=2):
    fp = [brute_print(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= threshold:
            top[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    name = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(repr((d, f"{fp[i]:016x}", name[find(i)])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("crowd", [1024, 0, 2])
def test_simhash_components_match_brute_force(spark, crowd):
    rng = random.Random(8)
    rows = text_rows(40)
    for base in range(6):  # near copies of a long text: few bits apart, in chains
        words = prose(rng, 250).split()
        for i in range(12):
            words[rng.randrange(250)] = "changed"
            rows.append((500 - 20 * base - i, " ".join(words)))
    rows += [(800 + i, "One hot TEXT of all") for i in range(60)] + [(3, "one hot\ttext of all"), (3, None), (None, "quite alone here now"), (900, "\x85 x")]
    docs = stored(spark, [(i, t, "x") for i, t in rows], SCHEMA + ", fp string", parts=5)
    got = anchor_simhash.near_duplicates(docs, crowd=crowd).collect()
    expected = brute_components(rows)
    assert sorted(repr(tuple(r)) for r in got) == expected
    assert len({r.component_id for r in got}) < len({r.fingerprint for r in got})


def test_simhash_of_nothing(spark):
    assert anchor_simhash.near_duplicates(stored(spark, [])).collect() == []


@pytest.mark.parametrize("crowd", [1 << 20, 3])
def test_links_connect_a_dense_ball(spark, crowd):
    """Fingerprints few bits from one centre, so that many live at one anchor, and random ones."""
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(250)}
    prints |= {rng.getrandbits(64) for _ in range(150)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = stored(spark, [(p,) for p in signed], "fp long")
    got = {(r.a, r.b) for r in anchor_simhash.links(df, crowd=crowd).collect()}
    near = {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got <= near if crowd == 3 else got == near

    def classes(pairs):
        top = {p: p for p in signed}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x
        for a, b in pairs:
            top[max(find(a), find(b))] = min(find(a), find(b))
        return {p: find(p) for p in signed}
    assert classes(got) == classes(near)


def test_code_covers_every_word():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 64, 2000, dtype=np.uint64)
    _, home, _ = anchor_simhash.anchors(words, 0)
    assert len(home) == len(words)  # one home each
    radius = np.array([int(x).bit_count() for x in words ^ home])
    assert radius.max() <= 3 + 3 + 4 + 4
    for size in (1, 2):
        other = words ^ np.array([sum(1 << int(b) for b in rng.choice(64, size, replace=False)) for _ in words], np.uint64)
        row, anchor, _ = anchor_simhash.anchors(other)
        assert set(zip(range(2000), home.tolist())) <= set(zip(row.tolist(), anchor.tolist()))
