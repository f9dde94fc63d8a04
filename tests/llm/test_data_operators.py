"""BPE, token files, packing, sharding, neighbours and the pipeline against brute force and round trips."""

import hashlib
import itertools
import os
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cvlens.llm import bpe, packing, projection_search, sharding, token_files, word_tokens
from cvlens.llm.common import numbered_scan, scratch
from cvlens.session import checkpoint_dir, ship_package
from test_text_operators import SCHEMA, brute_links, brute_repeats, prose, stored, toxic_rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD_TEXTS = [
    None, "", " ", "  a", "a  b  c", "a \n b", "a\nb\n\nc ", "it's  don't 're ''s", "\t\tx y", "x\x1c y\x1d z",
    "日本語 テスト, 。", " lead and trail ", "😀 👍🏽,ok.", "word " * 300, "word." * 50 + " " + "x" * 3000,
    "<|endoftext|> x <|startoftext|>", "a\r\nb \r\n c", "1234 56a7 x2² ªº µ", "ΑΣ ΟΔΟΣ Σ.", "İstanbul ﬁn é ́x", "Straße ÀÉ ÿ ß.",
    "foo),bar ).,( !!", "a b　c\x85d", "zero​width", "Hello, World!!",
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def rows_of(n=40, seed=1):
    rng = random.Random(seed)
    texts = ODD_TEXTS + [prose(rng, rng.randint(1, 400)) for _ in range(n)]
    return list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, "no name")]


def whole_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def with_end(t, text):
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


# ---- byte-level BPE --------------------------------------------------------

@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_bpe_is_that_of_the_library(spark, block_bytes):
    rows = rows_of()
    enc = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    encoded = bpe.encode_documents(stored(spark, rows), RANKS, public_tokenizers.PATTERN, block_bytes)
    got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in bpe.decode_documents(encoded, RANKS).collect())
    assert got == sorted((str(i), np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)


def test_bpe_of_nothing(spark):
    assert bpe.round_trip_digests(stored(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []
    r = bpe.round_trip_digests(stored(spark, [(1, None)]), RANKS, public_tokenizers.PATTERN).collect()
    assert [(x.n_tokens, x.ids_sha256) for x in r] == [(0, hashlib.sha256(b"").hexdigest())]


def test_an_unknown_id_is_an_error():
    with pytest.raises(ValueError):
        bpe.decode_ids(RANKS, [np.array([60_000], "<u4").tobytes()])


def test_block_forgets_pieces_but_not_words(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    block, find = bpe.Block(public_tokenizers.PATTERN), bpe.Block(public_tokenizers.PATTERN).find
    for text in [t for t in ODD_TEXTS if t] * 2:
        numbers = block.add(text)
        own = list(block.words)
        assert [own[i] for i in numbers] == find(text)


# ---- word tokens and files -------------------------------------------------

def test_word_tokens_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(word_tokens, "MAX_PIECES", 50)  # emptied between batches
    own, whole = word_tokens.WordTokenizer(WORDS), whole_tokenizer()
    for texts in (ODD_TEXTS, [t for _, t in rows_of(seed=2)], ODD_TEXTS):
        flat, counts = own.encode(texts)
        parts = np.split(flat, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files_round_trip(spark):
    rows, whole = rows_of(), whole_tokenizer()
    folder = scratch(spark, "token-test")
    manifest = token_files.write_token_files(stored(spark, rows), folder, WORDS, ranges=4, frame_ids=500)
    got = token_files.read_token_files(manifest).collect()
    ids = [with_end(whole, t) for _, t in rows]
    expected = sorted((str(i), len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, ids))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # gapless, in ascending order of doc_id
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    files = manifest.collect()
    assert sum(f.n_docs for f in files) == len(rows) and sum(f.n_ids for f in files) == at

    path = max(files, key=lambda f: f.n_docs).path
    fs, name = token_files.filesystem(path)
    with fs.open_input_file(name) as f:  # random access decompresses the asked frame alone
        reader = token_files.FrameReader(f)
        read, frame = [], reader.frame
        reader.frame = lambda k: read.append(k) or frame(k)
        by_id = {i: x for (i, _), x in zip(rows, ids)}
        (_, own), = reader.documents([len(reader.counts) - 1])
        assert own.tolist() == by_id[reader.doc_ids[-1]].tolist() and len(read) == 1
        body = f.seek(0) or f.read()
    import io

    import zstandard
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(body), read_across_frames=True).read()
    assert len(stream) == int(reader.raw_sizes.sum())  # plain tools read it as one stream
    with fs.open_output_stream(name) as f:  # a damaged frame is found
        f.write(body[:20] + bytes([body[20] ^ 1]) + body[21:])
    with pytest.raises(Exception):
        token_files.read_token_files(manifest).collect()


def test_token_files_of_nothing(spark):
    assert token_files.token_file_digests(stored(spark, []), WORDS).collect() == []


# ---- packing ---------------------------------------------------------------

def least_bins(lengths, capacity):
    """The least number of sequences, by exhaustive search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= lengths[i]:
                rest = list(rooms)
                rest.remove(r)
                place(i + 1, [*rest, r - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])
    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(9)
    beaten = 0
    for _ in range(150):
        capacity = rng.choice((20, 50, 97))
        lengths = [rng.randint(1, capacity - 1) if rng.random() < 0.5 else rng.randint(capacity // 4, capacity // 2) for _ in range(rng.randint(1, 10))]
        bins = packing.complete_bins(lengths, capacity)
        assert sorted(itertools.chain(*bins)) == sorted(lengths) and all(sum(b) <= capacity for b in bins)
        assert len(bins) == least_bins(lengths, capacity), (lengths, capacity)
        beaten += len(bins) < len(packing.best_fit_decreasing(lengths, capacity))
    assert len(packing.complete_bins([6, 5, 4, 4, 4, 3, 3, 3, 3, 5], 10)) == 4
    assert packing.complete_bins([], 10) == []


def test_bin_completion_beats_best_fit():
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    assert len(packing.best_fit_decreasing(lengths, 60)) == 4 and len(packing.complete_bins(lengths, 60)) == 3


def test_no_piece_is_lost_by_the_production_search():
    rng = random.Random(5)
    above_best_fit = above = 0
    for n in range(400):
        lengths = [rng.randint(400, 1500) for _ in range(60)]
        bins = packing.complete_bins(lengths)
        assert sorted(itertools.chain(*bins)) == sorted(lengths) and all(sum(b) <= 4096 for b in bins)
        bound = -(-sum(lengths) // 4096)
        above += len(bins) > bound
        above_best_fit += len(packing.best_fit_decreasing(lengths, 4096)) > bound
    assert above_best_fit > 50 and above < 10


@pytest.mark.parametrize("low, high, n", [(600, 1400, 3000), (1, 4095, 1500), (1300, 1500, 600)])
def test_a_group_places_every_piece_once(low, high, n):
    rng = random.Random(n)
    pieces = pd.DataFrame({"piece_key": range(n), "length": [rng.randint(low, high) for _ in range(n)], "grp": 0})
    got = packing._pack_group(4096, None)(pieces.copy())
    assert sorted(zip(got.piece_key, got.length)) == sorted(zip(pieces.piece_key, pieces.length))
    for _, members in got.groupby("bin"):
        members = members.sort_values("offset")
        ends = members.offset + members.length
        assert members.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 4096 and (members.room == 4096 - ends.max()).all()
    assert got.bin.nunique() <= len(packing.best_fit_decreasing(pieces.length.tolist(), 4096))


def test_fillings_are_all_undominated_ones():
    rng = random.Random(4)
    for _ in range(60):
        lengths = [rng.randint(3, 40) for _ in range(9)]
        room, most_waste = rng.randint(20, 90), rng.randint(0, 15)
        shelf = packing._Shelf(lengths, 100)
        before = list(shelf.count), shelf.bits
        got = list(packing.fillings(shelf, room, most_waste, packing._Steps(10 ** 6)))
        next(packing.fillings(shelf, room, most_waste, packing._Steps(10 ** 6)), None)  # an abandoned one changes nothing
        assert (list(shelf.count), shelf.bits) == before and len(set(got)) == len(got)
        every = {tuple(sorted(c, reverse=True)) for k in range(10) for c in itertools.combinations(lengths, k) if sum(c) <= room}
        if room in lengths:
            assert got == [(room,)]
            continue

        def dominated(f):
            left = list(lengths)
            for x in f:
                left.remove(x)
            gap = room - sum(f)
            return any(x <= gap for x in left) or any(y < x <= y + gap for x in left for y in f)
        assert set(got) == {f for f in every if room - sum(f) <= most_waste and not dominated(f)}


@pytest.mark.parametrize("group_tokens", [3000, 1 << 23])
def test_pieces_fill_sequences_without_gap(spark, group_tokens):
    rows, whole = rows_of(60) + [(500, "the and of " * 2000)], whole_tokenizer()
    got = packing.pack_documents(stored(spark, rows), WORDS, capacity=512, with_ids=True, group_tokens=group_tokens).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(with_end(whole, t))
    expected = sorted((str(i), p, min(512, len(x) - 512 * p), zlib.crc32(x[512 * p:512 * p + 512].tobytes()))
                      for i, xs in ids.items() for x in xs for p in range(-(-len(x) // 512)))
    assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in got) == expected
    assert all(r.start == 512 * r.piece and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 512
    full = sum(r.length == 512 for r in got)
    rest = sum(r.length for r in got if r.length < 512)
    last_groups = 1 if group_tokens > rest else 6  # a sequence may stay open in each group of the second round
    assert len(sequences) <= full + -(-rest // 512) + last_groups


def test_packing_nothing(spark):
    assert packing.pack_documents(stored(spark, []), WORDS).collect() == []
    assert [(r.piece, r.length) for r in packing.pack_documents(stored(spark, [(1, None)]), WORDS).collect()] == [(0, 1)]


# ---- sharding --------------------------------------------------------------

def test_shards_are_even_and_whole(spark):
    rows = rows_of(200) + [(7, "hot")] * 150
    docs = stored(spark, [(i, t, "clash", "b", "p") for i, t in rows], SCHEMA + ", slot string, bucket string, place string")
    path, again = scratch(spark, "shards"), scratch(spark, "shards")
    for p in (path, again):
        sharding.two_pass_shuffle(docs, p, n_shards=7, bucket_bytes=4096)
    back = sharding.read_shards(spark, path, SCHEMA + ", bucket string, place string, slot long, shard int").collect()
    assert {(r.bucket, r.place) for r in back} == {("b", "p")}
    read = lambda p: [tuple(r) for r in sharding.read_shards(spark, p, SCHEMA + ", slot long, shard int").collect()]
    got = read(path)
    assert sorted(map(repr, read(again))) == sorted(map(repr, got))  # the seed fixes the draw
    assert sorted(map(repr, rows)) == sorted(repr(r[:2]) for r in got)
    by_shard = {}
    for _, _, slot, shard in got:
        by_shard.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(k, [])) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    place = sorted((slot * 7 + shard, i) for i, _, slot, shard in got if i is not None)
    assert [i for _, i in place] != sorted(i for _, i in place)


def test_shards_draw_every_order_alike():
    """The permutation of one bucket is uniform: each record is as often at each place (chi-square over many seeds)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    n, runs = 6, 1200
    drawn = spark.range(runs).select(F.shuffle(F.lit(list(range(n))).cast("array<int>"), 5).alias("a")).collect()
    counts = np.zeros((n, n))
    for r in drawn:
        for place, x in enumerate(r.a):
            counts[x, place] += 1
    expected = runs / n
    assert ((counts - expected) ** 2 / expected).sum() < 60  # 25 degrees of freedom: beyond 0.9999


def test_shards_hold_when_scans_are_split_otherwise(spark, monkeypatch):
    """Counts and records come from two scans; here the second is split otherwise."""
    docs = stored(spark, rows_of(60), parts=2)
    split, was = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    plain = sharding.scan_place
    monkeypatch.setattr(sharding, "scan_place", lambda df: (spark.conf.set(split, "1k"), plain(df))[1])
    try:
        path = scratch(spark, "shards")
        sharding.two_pass_shuffle(docs, path, n_shards=3, bucket_bytes=2048)
        got = sharding.read_shards(spark, path, SCHEMA + ", slot long, shard int").collect()
    finally:
        spark.conf.set(split, was)
    assert len(got) == len({(r.shard, r.slot) for r in got}) == docs.count()


def test_shard_digests(spark):
    rows = rows_of(5)
    got = sharding.shard_digests(stored(spark, rows)).collect()
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == expected
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.shard_digests(stored(spark, [])).collect() == []


# ---- neighbours ------------------------------------------------------------

def test_chi_square_quantile():
    assert projection_search.chi_square_quantile(0.95, 8) == pytest.approx(15.50731, abs=1e-4)
    assert projection_search.chi_square_quantile(0.5, 2) == pytest.approx(1.386294, abs=1e-5)


@pytest.mark.parametrize("block_rows", [150, 400, 4000])
def test_neighbours_reach_the_recall(spark, block_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows[40] = (40, rows[20][1])
    odd = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [1.0] * 3), (2100, [float("inf")] * 16), (None, rows[0][1])]
    # one query row twice, its id on another vector, and a neighbour twice
    rows += [rows[60], (60, rows[7][1]), rows[61]]
    vectors = stored(spark, rows + odd, "vec_id long, embedding array<float>")
    got = projection_search.nearest(vectors, F.col("vec_id") % 20 == 0, k=10, block_rows=block_rows, query_group=30).collect()
    exact, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 1500, 20)) and len(found.pop(60)) == 30
    hits = 0
    for q, own in found.items():
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        dots = exact @ exact[q]
        for r in own:
            assert any(r.score == pytest.approx(d, rel=1e-12) for d in dots[ids == r.vec_id])
        dots[q] = -np.inf
        best = np.lexsort((ids, -dots))[:10]
        hits += sum(min(sum(r.vec_id == i for r in own), int((ids[best] == i).sum())) for i in set(ids[best].tolist()))
    assert hits >= 0.95 * 10 * len(found)


def test_rows_that_share_an_id_are_queries_and_candidates(spark):
    """Certain enough, the search is exact: compared with brute force by place."""
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.integers(0, 30, 120), rng.normal(size=(120, 4)))]
    rows += [rows[0]] * 40  # a group of copies, some of them queries
    rows = [(0 if i % 5 == 0 else r[0], r[1]) for i, r in enumerate(rows)]
    got = projection_search.nearest(stored(spark, rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=7,
                                    block_rows=20, query_group=9, certainty=1 - 1e-9).collect()
    x, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    expected = []
    for q in np.flatnonzero(ids % 10 == 0):
        dots = x @ x[q]
        dots[q] = -np.inf
        expected += [(int(ids[q]), rank, int(ids[i]), round(float(dots[i]), 9)) for rank, i in enumerate(np.lexsort((ids, -dots))[:7], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(expected)


def test_neighbours_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert projection_search.nearest(stored(spark, [], schema), F.col("vec_id") % 20 == 0).collect() == []
    got = projection_search.nearest(stored(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.0])], schema), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


# ---- the pipeline ----------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(21)
    rows, labels = toxic_rows(rng, 300)
    clean = [t for (_, t), (_, y) in zip(rows, labels) if not y]
    passage = prose(rng, 90)
    base = prose(rng, 200).split()
    extra = [clean[0], clean[0].upper() if clean[0].isascii() else clean[0], None, "", None, " ".join(base), " ".join(base[:-1] + ["end"]),
             *(prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(6))]
    rows += [(1000 + i, t) for i, t in enumerate(extra)] + [(1005, extra[5])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, rid string, kept boolean, place string, given int"
    docs = [(i, t, "en", "s", len(t or ""), 0.5, "r", True, "p", 4) for i, t in rows]
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    own, out = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, own, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before, own = [(r.doc_id, r.text) for r in own.collect()], spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert own.columns == schema.replace(",", "").split(" ")[::2]
        out[name] = before, own.collect()

    marked = dict(labels)
    assert sorted(r.doc_id for r in out["toxicity"][1]) == sorted(i for i, _ in rows if not marked.get(i))

    before, after = out["exact_dedup"]
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    assert sorted(r.doc_id for r in after) == sorted({fold(t): i for i, t in sorted(before)}.values())

    before, after = out["near_dedup"]
    _, classes = brute_links(before)
    stays = {}
    for (i, _), c in zip(before, classes):
        stays[c] = min(i, stays.get(c, i))
    assert sorted(r.doc_id for r in after) == sorted(stays.values())

    before, after = out["repeated_passages"]
    expected = {i: None if t is None else x[3].decode("utf-8", "ignore") for (i, t), x in zip(before, brute_repeats([t for _, t in before]))}
    assert {r.doc_id: r.text for r in after} == expected and any(len(t or "") != len(expected[i] or "") for i, t in before)
    assert all(r.text is None or r.n_chars == len(r.text) for r in after)

    whole = whole_tokenizer()
    packed = {}
    for r in out["packing"][1]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == {i: len(with_end(whole, t)) for i, t in expected.items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(out["packing"][1])


def test_stages_store_no_copy_of_a_stored_table(spark, tmp_path):
    rng = random.Random(4)
    passage, base = prose(rng, 90), prose(rng, 120).split()
    texts = [*(prose(rng, 30) + passage + prose(rng, 30) for _ in range(5)), " ".join(base), " ".join(base[:-1] + ["end"]), "a", "A", None]
    docs = spark.createDataFrame([(i % 9, t, "en", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_chars int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    shared, table = checkpoint_dir(spark).removeprefix("file:"), spark.read.parquet(f"{tmp_path}/documents.parquet")
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.cut_passages):
        before = set(os.listdir(shared))
        got = sorted(map(str, stage(spark, table, str(tmp_path)).collect()))
        stored_tables = {x for x in set(os.listdir(shared)) - before if "text" in spark.read.parquet(f"{shared}/{x}").columns}
        assert not stored_tables
        assert got == sorted(map(str, stage(spark, table.filter("doc_id >= 0"), str(tmp_path)).collect()))  # no plain scan: stored


def test_rows_of_a_scan_have_the_same_number_in_every_scan(spark, tmp_path):
    path = f"{tmp_path}/a b.parquet"
    rows = spark.range(3000).selectExpr("id", "id % 7 AS path", "id AS row", "1.5 AS `x.y`")
    rows.repartition(3).write.option("parquet.block.size", 2048).parquet(path)
    found = []
    for split in (1 << 27, 4096):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            scan = numbered_scan(spark.read.parquet(path), "place")
            assert scan.columns == [*rows.columns, "place"] and not scan.schema["place"].nullable
            found.append((scan.rdd.getNumPartitions(), {r.id: r.place for r in scan.collect()}, scan.count()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0][0] < found[1][0] and found[0][1:] == found[1][1:]
    assert len(set(found[0][1].values())) == 3000 and min(found[0][1].values()) >= 0
    assert numbered_scan(spark.read.parquet(f"{path}/*.parquet").limit(0), "place") is None


def test_only_plain_scans_are_numbered(spark, tmp_path):
    spark.range(20).selectExpr("id AS doc_id", "'t' AS text").write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    assert numbered_scan(scan, "place").select("place").distinct().count() == 20
    twice = scan.select("doc_id", "text", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    for other in (twice, scan.filter("doc_id > 3"), scan.crossJoin(spark.range(2)), scan.unionByName(scan), scan.select("text", "doc_id"), spark.range(3)):
        assert numbered_scan(other, "place") is None
    assert [r.doc_id for r in corpus_pipeline.drop_copies(spark, twice, str(tmp_path)).collect()] == [19]


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
