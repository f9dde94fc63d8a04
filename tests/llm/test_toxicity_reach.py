"""Tokens are read only where some reading may have a toxic feature, with the same evidence as if all were read."""

import random

import numpy as np

from cvlens.llm import toxicity as T


def _model():
    rng = np.random.default_rng(3)
    return np.log(rng.dirichlet(np.ones(T.N_CLASSES), (T.N_CLASSES, T.N_CLASSES))).astype(np.float32)


def test_only_tokens_that_may_be_toxic_are_read(monkeypatch):
    rnd, chars = random.Random(5), _model()
    alpha = "abcehilostué01345@$!|+(*.-_,'"
    tokens = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 14))) for _ in range(1500)]
    read = [f for t in tokens[:60] for w in T.plain_forms(t, chars.tolist()) for f in T.word_features(w)]
    for features in (["=hell", "^hell", "$hells"], read):
        scorer = T.WordScorer(chars, {f: (5, 1) for f in features}, 0.1, 4.0)
        for t in [*tokens, "h3ll", "h.e.l.l", "hheellls!", "x-he11s", "hells", "...", ""]:
            assert scorer.token(t) == scorer._look(T.plain_forms(t, scorer.costs)), t
    scorer = T.WordScorer(chars, {"=hell": (5, 1), "^hell": (5, 1)}, 0.1, 4.0)
    asked = []
    monkeypatch.setattr(T, "readings", lambda span, model, n=5: asked.append(span) or [span])
    scorer.evidence("oouuoouu-ttoottoo c@lmly 55.63.178.142 a a a a h3ll")
    assert asked == ["h3ll"]


def test_spaced_out_spans():
    for text, want in (("a b c", ["a b c"]), ("a. b, (c x1 d e", ["a b c"]), ("h 3 l l 0 no a b c d", ["h 3 l l 0", "a b c d"]),
                       ("1 2 3", []), ("ab a b ab c d", []), ("", []), ("x a. b, c", ["x a b c"])):
        assert T.spaced_out(text.split()) == want
