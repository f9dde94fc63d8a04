"""Toxicity, URL filter, exact dedup, near dedup and repeated passages against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cvlens.llm import chosen_path, common, exact_dedup, suffix_dedup, toxicity, url_filter
from cvlens.llm.common import scratch
from cvlens.session import ship_package

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def stored(spark, rows, schema=SCHEMA, parts=3):
    path = scratch(spark, "test")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def prose(rng, n):
    return " ".join("".join(rng.choice(("an", "the", "or", "ti", "ó", "er", "ß")) for _ in range(rng.randint(1, 4))) for _ in range(n))


# ---- exact dedup -----------------------------------------------------------

@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups_match_brute_force(spark, keep):
    rng = random.Random(3)
    texts = ["Same TEXT", "same text", None, "", "ÀB", "àb", "x" * 50_000, "X" * 50_000] + [prose(rng, 5) for _ in range(30)]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(5, "same text"), (5, "same text"), (None, "same text"), (None, None)]
    rows += [(1000 + i, "hot") for i in range(200)]  # a third of all rows
    got = exact_dedup.exact_groups(stored(spark, rows, parts=7), keep=keep, ranges=9).collect()
    norm = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    assert len(got) == len(rows)
    best = max if keep == "max" else min
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (best(known) if known else None, len(ids))
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(stored(spark, [])).collect() == []


# ---- near dedup ------------------------------------------------------------

def shingles(text):
    words = re.findall(r"(?:[a-z0-9_]|[^\x00-\x7f])+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute_links(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links, top = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= threshold * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
            top[max(find(i), find(j))] = min(find(i), find(j))
    return links, [find(i) for i in range(len(rows))]


def near_rows():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(0, 120))) for i in range(60)]
    base = prose(rng, 150).split()
    for i in range(90):  # one family, larger than a small bucket
        own = list(base)
        own[rng.randrange(len(own))] = f"w{i}"
        rows.append((100 + i, " ".join(own)))
    rows += [(200, None), (201, ""), (202, "Two words"), (203, "two, WORDS!"), (204, " ".join(base)), (204, " ".join(base)), (205, "...")]
    rows += [(300 + i, "all of these are the very same copies") for i in range(70)]
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    got = chosen_path.near_duplicates(stored(spark, rows), small=16, block=32).collect()
    links, classes = brute_links(rows)
    expected = sorted((i, n, min(rows[j][0] for j in range(len(rows)) if classes[j] == c)) for (i, _), n, c in zip(rows, links, classes))
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got) == expected
    assert len({r.class_rid for r in got}) == len(set(classes))


def test_near_duplicates_of_nothing(spark):
    assert chosen_path.near_duplicates(stored(spark, [])).collect() == []
    assert [tuple(r)[:3] for r in chosen_path.near_duplicates(stored(spark, [(1, None)])).collect()] == [(1, 1, 0)]


def test_runs_reach_the_recall():
    assert chosen_path.runs_for(0.99, 1) == 5 and chosen_path.runs_for(0.99, 3) == 10
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        roots = chosen_path.mix64(np.arange(1, 11, dtype=np.uint64) * chosen_path._BASE)
        met = 0
        for _ in range(300):  # pairs of similarity 0.8
            u = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
            a, b = np.unique(u[:180]), np.unique(u[20:])
            met += bool(np.intersect1d(chosen_path.paths(a, roots, 0.8, 3)[2][1], chosen_path.paths(b, roots, 0.8, 3)[2][1]).size)
    assert met >= 290


# ---- repeated passages -----------------------------------------------------

def brute_repeats(texts, window=200):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for k in range(len(b) - window + 1):
            seen[b[k:k + window]] = seen.get(b[k:k + window], 0) + 1
    out = []
    for b in raw:
        covered = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                covered[k:k + window] = True
        runs = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(covered.sum()), runs, bytes(c for c, x in zip(b, covered) if not x)))
    return out


@pytest.mark.parametrize("large", [suffix_dedup.LARGE, 3, 0])
def test_repeats_match_brute_force(spark, large):
    rng = random.Random(7)
    passage = prose(rng, 80)
    texts = [prose(rng, rng.randint(0, 150)) for _ in range(30)] + [None, "", "é" * 99, "é" * 150, "a" * 199, "a" * 200, "b" * 201]
    texts += [prose(rng, 30) + passage + prose(rng, 30) for _ in range(25)]
    texts += [passage[:205], passage[3:210] + "z", texts[0], texts[0], "q" + texts[1], passage[:199]]
    whole = texts[2] + passage + texts[3]
    texts += [whole[k:k + 260] for k in range(0, 300, 37)]
    rows = list(enumerate(texts)) + [(0, texts[5])]
    got = suffix_dedup.remove_repeats(stored(spark, rows), large=large).collect()
    expected = sorted((i, *x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows])))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == expected
    assert suffix_dedup.remove_repeats(stored(spark, [])).collect() == []


def test_suffix_order_is_that_of_the_bytes():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 99, 4000, dtype=np.uint8)
    start = rng.integers(0, 3900, 300)
    length = np.minimum(rng.integers(0, 100, 300), 4000 - start)
    group = np.sort(rng.integers(0, 9, 300))
    with np.errstate(over="ignore"):
        order, lcp = suffix_dedup.Suffixes(raw, start, length).order(group)
    text = [raw[s:s + m].tobytes() for s, m in zip(start, length)]
    expected = sorted(range(300), key=lambda i: (group[i], text[i]))
    assert [text[i] for i in order] == [text[i] for i in expected]
    for k in range(1, 300):
        a, b = text[order[k - 1]], text[order[k]]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == (common if group[k] == group[k - 1] else -1)


def test_a_hash_collision_is_found_on_the_bytes(monkeypatch):
    raw = np.frombuffer(b"abcabdabe", np.uint8)
    s = suffix_dedup.Suffixes(raw, np.array([0, 3, 6]), np.array([3, 3, 3]))
    monkeypatch.setattr(s, "common", lambda i, j: np.minimum(s.length[i], s.length[j]))  # every hash collides
    order, lcp = s.order(np.zeros(3, np.int64))
    assert order.tolist() == [0, 1, 2] and lcp.tolist() == [-1, 2, 2]


def test_a_very_long_document_is_cut_without_loss(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 300_000, dtype=np.uint8).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 7, 8]), pa.array([1, 2, 3]), pa.array([b"x" * 500, text, b"y" * 300])],
                                       ["rid", "doc_id", "text"])

    def strings(chunk):
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
        rows = [r for b in suffix_dedup._anchor_rows(200, 40)([batch]) for r in zip(*(c.to_pylist() for c in b.columns))]
        return sorted((r[2], r[3], s) for r in rows for s in range(r[4], r[4] + r[5] + 1))
    assert strings(1 << 14) == strings(1 << 23)


# ---- toxicity --------------------------------------------------------------

def toxic_rows(rng, n=600):
    bad = ["zornbrak", "zornfeld", "plimvex"]
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 80)).split()
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_learns_words_and_reads_through_disguise(spark):
    rows, labels = toxic_rows(random.Random(1))
    extra = [(9000, None), (9001, ""), (9002, "the or z0rnbr@k an pl1mv3x er"), (9003, "the z o r n b r a k or p-l-i-m-v-e-x"),
             (9004, "zornnnnbrak the plimvexxxx an"), (9005, "an " * 40_000), (9006, "the or an"), (9006, "the or an")]
    docs = stored(spark, rows + extra)
    model = toxicity.fit(docs, stored(spark, labels + [(None, 1), (3, None), (5, 7)], "doc_id long, toxic int"))
    got = toxicity.score_documents(docs, model).collect()
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    said = {r.doc_id: r.predicted for r in got}
    assert [said[9000 + i] for i in range(7)] == [0, 0, 1, 1, 1, 0, 0]
    assert len(got) == len(rows) + len(extra)


def test_held_out_labels_are_not_learnt_from(spark):
    rows, labels = toxic_rows(random.Random(2))
    docs, zero = stored(spark, rows), __import__("zlib").crc32
    flipped = [(i, 1 - y if zero(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.fit(docs, stored(spark, x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a.toxic == b.toxic and np.array_equal(a.weights, b.weights)
    marks = {r.doc_id: r.held_out for r in docs.select("doc_id", toxicity.held_out().alias("held_out")).collect()}
    assert all(h == (zero(str(i).encode()) % 5 == 0) for i, h in marks.items())


def test_toxicity_without_labels_or_rows(spark):
    docs = stored(spark, [(1, "a b"), (2, None)])
    none = toxicity.fit(docs, stored(spark, [], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score_documents(docs, none).collect()] == [0.0, 0.0]
    empty = stored(spark, [])
    model = toxicity.fit(empty, stored(spark, [(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert toxicity.score_documents(empty, model).collect() == []


# ---- URL filter ------------------------------------------------------------

def test_url_verdicts(spark):
    cases = [
        (1, None, "", "", None, "allow"), (2, "", "", "", None, "allow"), (3, "no scheme porn", "", "", None, "block"),
        (4, "http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        (5, "https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (6, "https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
        (7, "http://shop.com", "shop.com", "", None, "allow"), (8, "http://shop.com/", "shop.com", "/", "com/", "allow"),
        (9, "http://porn.com/", "porn.com", "/", "com/", "allow"), (10, "http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        (11, "http://a.net/de/", "a.net", "/de/", None, "allow"), (12, "http://a.org/casino", "a.org", "/casino", None, "allow"),
        (13, "http://a.org/casino/poker", "a.org", "/casino/poker", None, "block"),
        (14, "http://a.org/casino-casino", "a.org", "/casino-casino", None, "allow"),
        (15, "http://a.org/XXX", "a.org", "/XXX", None, "block"), (16, "http://a.org/xxxl", "a.org", "/xxxl", None, "allow"),
        (17, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        (18, "http://h?p/../x", "h", "", None, "allow"), (19, "x://", "", "", None, "allow"), (20, "a://b://c/d", "b:", "//c/d", None, "allow"),
    ]
    pages = stored(spark, [(c[0], c[1], "old") for c in cases] + [(20, cases[-1][1], "old")], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert got == {c[0]: c[2:] for c in cases}
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_term_hits_against_patterns():
    rng = random.Random(4)
    strict, soft = ("ab", "abc", "c-d"), ("b", "ca", "d")
    for _ in range(2000):
        text = "".join(rng.choice("abcd-/.é") for _ in range(rng.randint(0, 12)))
        hits = lambda t: len(re.findall(rf"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", text))
        terms = tuple(url_filter.Term(t, t in strict, 1.0 + len(t)) for t in (*strict, *soft))
        assert url_filter.term_hits(text, terms) == (sum(map(hits, strict)), sum((hits(t) > 0) * (1.0 + len(t)) for t in soft))


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "v.tsv").write_text("# comment\nsoft\t0.5\ten\tFoo\nsoft\t1.5\tde\tfoo\nstrict\t1\t*\tbar\n\nsoft\t1\tfr\tbaz\n")
    terms = url_filter.load_vocabulary(spark, str(tmp_path / "v.tsv"))
    assert [tuple(t) for t in terms] == [("bar", True, 1.0), ("baz", False, 1.0), ("foo", False, 1.5)]
    pages = stored(spark, [(1, "x://h/foo"), (2, "x://h/foo-BAZ"), (3, "x://h/bar"), (4, "x://h/barn")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.filter_urls(pages, terms=terms).collect()} == {1: "allow", 2: "block", 3: "block", 4: "allow"}
    for bad in ("soft\t1\ten", "hard\t1\ten\tx", "soft\t0\ten\tx", "soft\tmuch\ten\tx", "soft\t1\ten\t "):
        with pytest.raises(ValueError):
            url_filter.parse_vocabulary([bad])
    own = url_filter.own_vocabulary()
    assert len(own) > 50 and all(t.term == t.term.lower() for t in own)
    verdicts = {"x://h/gratis/gewinnspiel": "block", "x://h/apuestas?premio=1": "block", "x://h/rencontres-gratuit": "block", "x://h/gratis": "allow"}
    pages = stored(spark, list(enumerate(verdicts)), "page_id long, url string")
    assert {r.url: r.verdict for r in url_filter.filter_urls(pages).collect()} == verdicts


def test_equal_evidence_counts_as_often_as_it_is_there():
    rng = np.random.default_rng(1)
    x, y = np.repeat(rng.normal(size=(12, 3)), 30, axis=0), rng.integers(0, 2, 360)
    rows, times = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    assert np.allclose(toxicity.logistic_fit(x, y), toxicity.logistic_fit(rows[:, :3], rows[:, 3], times=times.astype(float)))


def test_readings_are_the_likeliest_of_all(monkeypatch):
    """The list Viterbi against every way through the lattice, on short spans."""
    rng = np.random.default_rng(3)
    counts = rng.random((toxicity.N_CLASSES,) * 3) ** 6 + 1e-4
    model = np.log(counts / counts.sum(2, keepdims=True)).astype(np.float32)

    def ways(span):
        paths = [(0.0, "", 0, 0)]
        before = ""
        for c in span:
            if c.isalpha():
                options = [*toxicity._AS_IS[c], *([("", 0, toxicity.REPEAT_COST)] if c == before else [])]
            else:
                options = toxicity._SYMBOLS.get(c, toxicity._NO_LETTER)
            before = c
            after = []
            for p, text, a, b in paths:
                for out, k, cost in options:
                    if not out:
                        after.append((p + cost, text, a, b))
                    elif out != " " or b != 0:
                        after.append((p + cost - float(model[a][b][k]), text + out, b, k))
            paths = after
        best = {}
        for p, text, a, b in paths:
            p -= float(model[a][b][0])
            best[text] = min(p, best.get(text, np.inf))
        return best
    for span in ("id10t", "m0r0n", "a-b", "stt1", "b b", "x.y.z", "4ss", "ll00"):
        best = ways(span)
        got = toxicity.readings(span, model)
        assert got and len(got) == len(set(got))
        costs = [min(v for t, v in best.items() if t.strip() == g.strip()) for g in got]
        assert costs[0] == pytest.approx(min(best.values()), abs=1e-3), span


def test_toxicity_decodes_each_kind_of_disguise():
    words = ["moron", "idiot", "crass", "dumbass", "idiots", "stupid", "you", "are", "so"] * 40
    counts = np.full((toxicity.N_CLASSES,) * 3, 0.1)
    for batch in toxicity._count_trigrams([pa.RecordBatch.from_arrays([pa.array([" ".join(words)])], ["text"])]):
        counts.reshape(-1)[batch.column(0).to_numpy()] += batch.column(1).to_numpy()
    model = np.log(counts / counts.sum(2, keepdims=True)).astype(np.float32)
    for token, word in {"mor.on": "moron", "id-iot": "idiot", "cr455": "crass", "dumb455": "dumbass", "id1075": "idiots",
                        "stuupid": "stupid", "m0ron": "moron", "i.d.i.o.t": "idiot"}.items():
        assert word in toxicity.plain_forms(token, model), token
        assert toxicity.plain_forms(token, model) == toxicity.plain_forms(token, model.tolist())
    assert {"don", "t"} <= set(toxicity.plain_forms("don't", model)) and "hello" in toxicity.plain_forms("hello!!!", model)
    assert toxicity.plain_forms("moron", model) == ["moron"] and toxicity.plain_forms("1234", model) == []
    assert toxicity.spaced_out("he is s o so".split()) == [] and toxicity.spaced_out("a s s".split()) == ["a s s"]
    assert "you idiot" in toxicity.readings("y o u i d i o t", model)
    scorer = toxicity.WordScorer(model, {"=idiot": (9, 0)}, 0.1, 4.0)
    for text in ("y o u i d i o t", "i, d, i, o, t,", "an id-iot"):
        assert scorer.evidence(text)[0] > scorer.evidence("an apple")[0], text


def test_places_hold_when_later_scans_are_split_otherwise(spark, monkeypatch):
    import corpus_pipeline
    split, was = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")

    def shifting(df, what, store=common.written):
        out = store(df, what)
        spark.conf.set(split, "2k" if spark.conf.get(split) != "2k" else was)
        return out

    for module in (suffix_dedup, chosen_path, exact_dedup, corpus_pipeline):
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", shifting)
    rng = random.Random(8)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, 40) + (shared if i % 4 == 0 else "") + prose(rng, 40)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 3)] + [(200 + i, rows[i][1] + " end") for i in range(1, 60, 3)]
    docs = stored(spark, rows, parts=12)
    try:
        got = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()}
        near = {r.doc_id: r.class_id for r in chosen_path.near_duplicates(docs).collect()}
        spark.conf.set(split, was)
        copies = sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect())
        spark.conf.set(split, was)
        firsts = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    finally:
        spark.conf.set(split, was)
    assert got == {i: x[0] - x[1] for (i, _), x in zip(rows, brute_repeats([t for _, t in rows]))}
    assert {i: near[i] for i in near if i >= 100} == {**{100 + i: i for i in range(0, 60, 3)}, **{200 + i: i for i in range(1, 60, 3)}}
    assert copies == sorted(i for i, _ in rows if i >= 100 or i % 3)
    assert firsts == list(range(60))
