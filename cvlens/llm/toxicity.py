"""Toxicity: noisy-channel deobfuscation, then a word classifier on the restored text.

1. A character trigram model is counted over all documents (lower-cased; 62
   classes of characters, so the table is bounded whatever the corpus).
2. Every word with a digit, a symbol or a separator in or after it, or a letter
   twice in a row, and every run of three or more single letters, is a
   lattice: each observed character may stand for itself, for the letters it
   imitates, for nothing, or (no letter) for a word break. A list Viterbi search finds the likeliest
   readings under channel costs and the character model.
3. A classifier scores words and their readings by their beginnings, endings
   and whole spelling. It learns from labelled rows only: for each feature, in
   how many toxic and clean documents it occurs. A document's evidence is its
   two most toxic words and how many look toxic; a logistic regression, fitted
   to evidence from which the document's own counts are taken out, turns that
   into the score.

Learning uses at most about ``MAX_LABELLED`` labelled rows, drawn by a hash of
the identifier; everything else sees all rows and whole texts. Labels of a
document that occurs twice count once, toxic first. Without usable labels of
both kinds every score is the share of toxic labels (0 with none at all).

Null texts count as empty; an empty text has the score of no evidence.
Repeated rows are scored alike. An empty table gives an empty result. Extra
columns of ``score_documents``' input are kept, its own names replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.llm.common import claim_cache, table, text_or_empty

MAX_LABELLED = 20_000
N_CLASSES = 62  # boundary, a-z, U+00DF to U+00FF, any other letter, and one to spare
READINGS = 5

# What a character may stand for, beside itself.
IMITATES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "*": "aeiou"}
SEPARATORS = "._-*~/'· ​"
SWAP_COST, DROP_COST, REPEAT_COST, BREAK_COST, BLANK_COST = 0.5, 0.2, 0.3, 8.0, 2.0

_EDGES = ".,;:?\"()[]{}<>«»…“”„'`"
_RUNS = re.compile(r"(.)\1*")
_REPEATED = re.compile(r"([^\W\d_])\1")
_LETTER = re.compile(r"[^\W\d_]")
_WORDS = re.compile(r"[^\W\d_]+")


def char_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if "\xdf" <= c <= "\xff":
        return ord(c) - 0xDF + 27
    return 60 if c.isalpha() else 0


# ---- the character model -------------------------------------------------

def _count_trigrams(batches):
    import pyarrow as pa
    low = np.array([char_class(chr(i)) for i in range(256)], np.int64)
    n = N_CLASSES
    counts = np.zeros(n ** 3, np.int64)
    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                t = t.lower()
                try:
                    k = low[np.frombuffer(t.encode("latin-1"), np.uint8)]
                except UnicodeEncodeError:
                    k = np.array([char_class(c) for c in t], np.int64)
                k = np.concatenate([[0, 0], k, [0]])
                code = (k[:-2] * n + k[1:-1]) * n + k[2:]
                counts += np.bincount(code, minlength=n ** 3) if len(code) > 1 << 16 else 0
                if len(code) <= 1 << 16:
                    np.add.at(counts, code, 1)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(class | two classes before it), as an array of N_CLASSES^3, from all of ``docs``."""
    rows = (docs.select(text_or_empty()).mapInArrow(_count_trigrams, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(N_CLASSES ** 3)
    counts[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    counts = counts.reshape(N_CLASSES, N_CLASSES, N_CLASSES)
    smooth = 0.1
    return np.log((counts + smooth) / (counts.sum(2, keepdims=True) + smooth * N_CLASSES)).astype(np.float32)


# ---- the channel ---------------------------------------------------------

# Options of an observed character: what is written for it, its class, the cost.
_AS_IS = {c: [(c, char_class(c), 0.0)] for c in "abcdefghijklmnopqrstuvwxyz"}
_NO_LETTER = [("", 0, BREAK_COST), (" ", 0, BREAK_COST)]
_SYMBOLS = {c: [*((x, char_class(x), SWAP_COST) for x in IMITATES.get(c, "")),
                ("", 0, DROP_COST if c in SEPARATORS else BREAK_COST), (" ", 0, BLANK_COST if c == " " else BREAK_COST)]
            for c in {*IMITATES, *SEPARATORS}}


def readings(span: str, model, n: int = READINGS) -> list[str]:
    """The ``n`` likeliest restorations of an observed span (lower case).

    ``model``: the character model as an array, or as nested lists, which are faster to look up.
    """
    a, b, p, before, lead = 0, 0, 0.0, "", 0
    for c in span:  # the letters in front have one way
        if not c.isalpha() or c == before:
            break
        k = char_class(c)
        p -= float(model[a][b][k])
        a, b, before, lead = b, k, c, lead + 1
    states: dict[tuple[int, int], list[tuple[float, str]]] = {(a, b): [(p, span[:lead])]}
    for at in range(lead, len(span)):
        c = span[at]
        if c.isalpha():
            options = _AS_IS[c] if c in _AS_IS else [(c, char_class(c), 0.0)]
            if c == before:
                options = [*options, ("", 0, REPEAT_COST)]
        else:
            options = _SYMBOLS[c] if c in _SYMBOLS else _NO_LETTER
        before = c
        if at == len(span) - 1:
            return _last(states, options, model, n)
        after: dict[tuple[int, int], list[tuple[float, str]]] = {}
        mixed = set()
        for (a, b), paths in states.items():
            row = model[a][b]
            for out, k, cost in options:
                if out:
                    if out == " " and b == 0:
                        continue
                    key = (b, k)
                    step = cost - float(row[k])
                    own = [(p + step, s + out) for p, s in paths]
                else:
                    key = (a, b)
                    own = [(p + cost, s) for p, s in paths]
                if key in after:
                    after[key] += own
                    mixed.add(key)
                else:
                    after[key] = own
        for key in mixed:  # the others are sorted and distinct as their one source is
            best: dict[str, float] = {}
            for p, s in sorted(after[key]):
                best.setdefault(s, p)
                if len(best) == n:
                    break
            after[key] = [(p, s) for s, p in best.items()]
        states = after
    return [span]


def _last(states: dict, options: list, model, n: int) -> list[str]:
    """The ``n`` best ends over the last character; paths above the n-th best so far are not spelled out."""
    best: dict[str, float] = {}
    bound = math.inf
    for (a, b), paths in states.items():
        row = model[a][b]
        for out, k, cost in options:
            if not out:
                step = cost - float(row[0])
            elif out == " " and b == 0:
                continue
            else:
                step = cost - float(row[k]) - float(model[b][k][0])
            for p, s in paths:
                p += step
                if p > bound:
                    break  # paths are sorted
                s = (s + out).strip()
                if p < best.get(s, math.inf):
                    best[s] = p
                    if len(best) > n:
                        del best[max(best, key=lambda x: (best[x], x))]
                    if len(best) == n:
                        bound = max(best.values())
    return sorted(best, key=lambda x: (best[x], x))


def _repeats(word: str, most: int = READINGS) -> list[str] | None:
    """All words that ``word`` may be without repetitions, if they are at most ``most`` and so all are readings."""
    runs = [m[0] for m in _RUNS.finditer(word)]
    if math.prod(map(len, runs)) > most:
        return None
    out = [""]
    for r in runs:
        out = [w + r[:k] for w in out for k in range(len(r), 0, -1)]
    return out


def plain_forms(token: str, model) -> list[str]:
    """The words that a blank-separated token (lower case) may stand for: itself, and its readings."""
    token = token.strip(_EDGES)
    if token.isalpha():
        if not _REPEATED.search(token):
            return [token]
        return _repeats(token) or [token, *readings(token, model)]
    words = _WORDS.findall(token)
    if not words:
        return []
    # the plain parts (don't, well-known) stay beside the readings
    return list(dict.fromkeys(words + [w for r in readings(token, model) for w in r.split()]))


def spaced_out(tokens: list[str]) -> list[str]:
    """Runs of at least three single letters (or imitations) as spans."""
    out, run, last = [], [], -1
    for i in [i for i, t in enumerate(tokens) if len(t) < 3] + [len(tokens) + 1]:
        t = tokens[i] if i < len(tokens) else ""
        c = t if len(t) == 1 else t.strip(_EDGES)
        single = len(c) == 1 and (c.isalpha() or c in IMITATES)
        if not single or i != last + 1:
            if len(run) >= 3 and any(x.isalpha() for x in run):
                out.append(" ".join(run))
            run = []
        if single:
            run.append(c)
            last = i
    return out


# ---- the classifier ------------------------------------------------------

def word_features(w: str) -> list[str]:
    """The whole word, its beginnings and its endings."""
    return ["=" + w, *("^" + w[:k] for k in (4, 5, 6) if len(w) >= k), *("$" + w[-k:] for k in (5, 6) if len(w) >= k)]


def _squeezed(w: str) -> str:
    return _RUNS.sub(r"\1", w)


class Reach:
    """Whether any reading of a span at all may have one of some features: a test that is never wrong when it denies.

    A reading keeps the span's letters but for repetitions, so with repetitions
    squeezed a word's beginning follows the span from its start or from behind a
    symbol, its end leads to the span's end or to a symbol.
    """

    def __init__(self, features):
        self.heads, self.tails = (self._paths(f) for f in (
            {_squeezed(f[1:]) for f in features if f[0] != "$"}, {_squeezed(f[:0:-1]) for f in features if f[0] == "$"}))

    @staticmethod
    def _paths(words: set[str]) -> dict[str, bool]:
        """Every beginning of a word, and whether it is a whole one."""
        paths = {w[:k]: False for w in words for k in range(1, len(w))}
        return paths | dict.fromkeys(words, True)

    @staticmethod
    def _meets(span: str, paths: dict[str, bool]) -> bool:
        if span.isalpha():  # one way
            squeezed = _squeezed(span)
            for k in range(1, len(squeezed) + 1):
                whole = paths.get(squeezed[:k])
                if not whole:
                    if whole is None:
                        return False
                    continue
                return True
            return False
        states, fresh = set(), True  # fresh: a word may begin here
        for c in span:
            if c.isalpha():
                if not states and not fresh:
                    continue
                after = set()
                for s in ({*states, ""} if fresh else states):
                    if s and s[-1] == c:
                        after.add(s)
                        continue
                    s += c
                    whole = paths.get(s)
                    if whole:
                        return True
                    if whole is not None:
                        after.add(s)
                states, fresh = after, False
                continue
            if c in IMITATES:
                begun = {*states, ""} if fresh else states
                for x in IMITATES[c]:
                    for s in begun:
                        if not s or s[-1] != x:
                            whole = paths.get(s + x)
                            if whole:
                                return True
                            if whole is not None:
                                states = states | {s + x}
            fresh = True
        return False

    def __call__(self, span: str) -> bool:
        return self._meets(span, self.heads) or self._meets(span[::-1], self.tails)


class WordScorer:
    """Documents -> evidence; keeps what it knows of a token while its worker lives."""

    MOST = 200_000

    def __init__(self, model: np.ndarray, toxic: dict[str, tuple[int, int]], base: float, smooth: float):
        self.model, self.toxic, self.base, self.smooth = model, toxic, base, smooth
        self.costs = model.tolist()
        self.reach = Reach(toxic)
        self.starts = {f[1:5] for f in toxic if f[0] != "$"}  # of whole words and beginnings
        self.ends = {f[-5:] for f in toxic if f[0] == "$"}
        self.known: dict[str, tuple] = {}  # tokens with features
        self.clean: set[str] = set()  # tokens without

    def share(self, a: float, b: float) -> float:
        return (a + self.smooth * self.base) / (a + b + self.smooth)

    def _look(self, forms: list[str]) -> tuple:
        """The token's toxic-leaning features with their counts."""
        return tuple(dict.fromkeys(f for w in forms for f in word_features(w) if f in self.toxic))

    def token(self, t: str) -> tuple:
        """The features of a blank-separated token; it is read only if some reading may have one."""
        t = t.strip(_EDGES)
        if t.isalpha() and not _REPEATED.search(t):
            return self._look([t]) if t[:4] in self.starts or t[-5:] in self.ends else ()
        return self._look(plain_forms(t, self.costs)) if self.reach(t) else ()

    def evidence(self, text: str, own: int | None = None) -> tuple[float, float, float]:
        """own: the document's label, whose counts are taken out."""
        low = (text or "").lower().split()
        if len(self.known) + len(self.clean) > self.MOST:
            self.known.clear()
            self.clean.clear()
        best: dict[tuple, float] = {}
        for t in set(low) - self.clean:
            found = self.known.get(t)
            if found is None:
                found = self.token(t)
                if not found:
                    self.clean.add(t)
                    continue
                self.known[t] = found
            best[found] = 0.0
        for span in spaced_out(low):
            found = self.reach(span) and self._look([w for r in readings(span, self.costs) for w in r.split()])
            if found:
                best[found] = 0.0
        a_own, b_own = (0, 0) if own is None else (own, 1 - own)
        shares = sorted((max(self.share(self.toxic[f][0] - a_own, self.toxic[f][1] - b_own) for f in found) for found in best),
                        reverse=True)
        top = [math.log(p / (1 - p)) for p in (*shares[:2], *[self.base] * 2)[:2]]
        return top[0], top[1], math.log1p(sum(p >= 0.5 for p in shares))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30, times: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the constant) by Newton's method; ``times``: how often each row counts."""
    x = np.column_stack([x, np.ones(len(x))])
    times = np.ones(len(x)) if times is None else times
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (times * (p - y)) + penalty * w
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class ToxicityModel:
    def __init__(self, chars, toxic, base, smooth, weights):
        self.chars, self.toxic, self.base, self.smooth, self.weights = chars, toxic, base, smooth, weights

    def scorer(self) -> WordScorer:
        return WordScorer(self.chars, self.toxic, self.base, self.smooth)

    def score(self, scorer: WordScorer, text: str) -> float:
        if self.weights is None:
            return self.base
        z = float(np.dot(self.weights, [*scorer.evidence(text), 1.0]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, smooth: float = 4.0,
        least: int = 3) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) that are not held out; the character model from all ``docs``."""
    sc = docs.sparkSession.sparkContext
    chars = character_model(docs)
    usable = (labels.filter(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic")))
    n = usable.count()
    if not n:
        return ToxicityModel(chars, {}, 0.0, smooth, None)
    parts = 1 << 30
    drawn = usable.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(parts)) < int(parts * min(1.0, max_labelled / n)))
    # At most about max_labelled rows of two numbers.
    known = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(drawn), "doc_id").select("text", "_toxic")
    shared = sc.broadcast(chars)

    def count(batches):
        import pyarrow as pa
        claim_cache("toxicity", _SCORERS.clear)
        costs = shared.value.tolist()
        kinds = (Counter(), Counter())
        size = [0, 0]
        forms: dict[str, list[str]] = {}
        for b in batches:
            for text, y in zip(*(c.to_pylist() for c in b.columns)):
                low, own = text.lower().split(), set()
                for t in set(low):
                    f = forms.get(t)
                    if f is None:
                        f = forms[t] = [x for w in plain_forms(t, costs) for x in word_features(w)]
                    own.update(f)
                for span in spaced_out(low):
                    own.update(x for r in readings(span, costs) for w in r.split() for x in word_features(w))
                kinds[y].update(own)
                size[y] += 1
        names = [f for f in kinds[1]]
        names += [f for f in kinds[0] if f not in kinds[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", *names], pa.string()), pa.array([size[1], *(kinds[1][f] for f in names)], pa.int64()),
             pa.array([size[0], *(kinds[0][f] for f in names)], pa.int64())], ["feature", "a", "b"])

    counted = known.mapInArrow(count, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    lean = F.col("a") * 2 >= F.col("b")  # at least a third of its documents are toxic
    rows = counted.filter((F.col("feature") == "") | ((F.col("a") >= least) & lean)).toPandas()
    sizes = rows[rows["feature"] == ""].iloc[0]
    total = int(sizes["a"] + sizes["b"])
    base = float(sizes["a"]) / total if total else 0.0
    if not 0 < base < 1:
        return ToxicityModel(chars, {}, base, smooth, None)
    toxic = {f: (int(a), int(b)) for f, a, b in rows[rows["feature"] != ""].itertuples(index=False)}
    model = ToxicityModel(chars, toxic, base, smooth, None)
    given = sc.broadcast(model)

    def seen(batches):
        import pyarrow as pa
        scorer = given.value.scorer()
        for b in batches:
            rows = [(*scorer.evidence(t, y), y) for t, y in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array([float(r[i]) for r in rows], pa.float64()) for i in range(4)],
                                             ["x1", "x2", "x3", "y"])

    # equal evidence is one row with its count: most rows have none, and copies, however many, have the same
    names = ["x1", "x2", "x3", "y"]
    rows = (known.mapInArrow(seen, ", ".join(f"{n} double" for n in names)).groupBy(*names).agg(F.count(F.lit(1)).alias("times"))
            .toPandas().sort_values(names))
    model.weights = logistic_fit(rows[names[:3]].to_numpy(), rows["y"].to_numpy(), times=rows["times"].to_numpy(float))
    return model


_SCORERS: dict[int, WordScorer] = {}


def score_column(spark: SparkSession, model: ToxicityModel, text: str = "text") -> Column:
    """The score (0 to 1) of a text column."""
    given = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd
        m = given.value
        claim_cache("toxicity", _SCORERS.clear)
        scorer = _SCORERS.get(id(m))
        if scorer is None or scorer.model is not m.chars:  # another model's scorer may have had the same address
            _SCORERS.clear()
            scorer = _SCORERS[id(m)] = m.scorer()
        return pd.Series([m.score(scorer, t) for t in texts], dtype="float64")

    return score(text_or_empty(text))


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 up)."""
    return (docs.withColumn("score", score_column(docs.sparkSession, model, text))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def toxicity_scores(spark, sf_dir: str) -> DataFrame:
    """The registered query."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
