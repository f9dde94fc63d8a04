"""URL filter: a weighted vocabulary matched by one Aho-Corasick pass, below host/path rules.

A URL is rejected by the vocabulary when it holds one strict term, or different
soft terms whose weights add up to ``min_soft`` or more. A term counts only
between boundaries: the characters beside it are no ASCII letters or digits.
Host rules decide first.

The vocabulary is a file of lines (kind, weight, language, term, separated by
tabs; ``#`` begins a comment), the package's own or any other that Spark can read;
rules are a parameter. A term on several lines keeps its largest weight, and
is strict if any of them is.

Null URLs, and URLs without ``://``, have an empty host and path, fit no rule
and are judged by the vocabulary on whatever text there is (null: none, so
they are allowed). Repeated rows are judged alike; an empty table gives an
empty result; extra columns of the input are kept by ``filter_urls`` unless
their name is one of the result's, which then replaces them.

Row-local: no shuffle, nothing goes to the tasks but the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache
from importlib.resources import files
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvlens.llm.common import ASCII_LOWER, ASCII_UPPER

# So much weight of different soft terms rejects.
MIN_SOFT = 2


class Term(NamedTuple):
    term: str
    strict: bool
    weight: float


def parse_vocabulary(lines: Iterable[str]) -> tuple[Term, ...]:
    """Lower-cased terms in order; a malformed line is an error."""
    found: dict[str, Term] = {}
    for line in lines:
        if not line.strip() or line.startswith("#"):
            continue
        parts = line.rstrip("\r\n").split("\t")
        if len(parts) != 4 or parts[0] not in ("strict", "soft") or not parts[3].strip() or float(parts[1]) <= 0:
            raise ValueError(f"no vocabulary line: {line!r}")
        term = parts[3].strip().translate(str.maketrans(ASCII_UPPER, ASCII_LOWER))
        old = found.get(term, Term(term, False, 0.0))
        found[term] = Term(term, old.strict or parts[0] == "strict", max(old.weight, float(parts[1])))
    return tuple(sorted(found.values()))


@lru_cache(maxsize=1)
def own_vocabulary() -> tuple[Term, ...]:
    """The package's terms, in English, German, Spanish and French."""
    return parse_vocabulary((files("cvlens.llm") / "url_terms.tsv").read_text("utf-8").splitlines())


def load_vocabulary(spark: SparkSession, path: str) -> tuple[Term, ...]:
    """A vocabulary file on any store that Spark reads; it is held whole, as the automaton is."""
    return parse_vocabulary(r.value for r in spark.read.text(path).collect())


# (verdict, host, path prefix)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


@lru_cache(maxsize=4)
def automaton(terms: tuple[Term, ...]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for t in terms:
        a.add_word(t.term, t)
    if len(a):
        a.make_automaton()
    return a


def _inside(c: str) -> bool:
    return c.isascii() and c.isalnum()


def term_hits(text: str | None, terms: tuple[Term, ...]) -> tuple[int, float]:
    """(strict hits, weight of the different soft terms) of a lower-cased text."""
    a = automaton(terms)
    if not text or not len(a):
        return 0, 0.0
    n_strict, seen, last = 0, {}, len(text)
    for end, t in a.iter(text):
        start = end - len(t.term) + 1
        if (start and _inside(text[start - 1])) or (end + 1 < last and _inside(text[end + 1])):
            continue
        if t.strict:
            n_strict += 1
        else:
            seen[t.term] = t.weight
    return n_strict, sum(seen.values())


def vocabulary_hits(col: Column, terms: tuple[Term, ...]) -> Column:
    @F.pandas_udf("n_strict int, soft_weight double")
    def hits(urls: pd.Series) -> pd.DataFrame:
        found = [term_hits(u, terms) for u in urls]
        return pd.DataFrame({"n_strict": pd.array([x[0] for x in found], "int32"), "soft_weight": pd.array([x[1] for x in found], "float64")})
    return hits(col)


def filter_urls(pages: DataFrame, url: str = "url", rules=RULES, terms: tuple[Term, ...] | None = None, min_soft: float = MIN_SOFT) -> DataFrame:
    """``pages`` with host, path, rule, n_strict, soft_weight and verdict (allow or block).

    The rule that fits with the longest ``host + path`` wins.
    """
    terms = own_vocabulary() if terms is None else terms
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ASCII_UPPER, ASCII_LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, h, p in reversed(ranked):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, said = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(said)
    hits = vocabulary_hits(F.translate(u, ASCII_UPPER, ASCII_LOWER), terms)
    own = F.when((hits["n_strict"] >= 1) | (hits["soft_weight"] >= min_soft), "block").otherwise("allow")
    return pages.withColumns({"host": host, "path": path, "rule": rule, "verdict": F.coalesce(said, own),
                              "n_strict": hits["n_strict"], "soft_weight": hits["soft_weight"]})


def oracle_sql() -> str:
    """DuckDB spelling of the query over ``pages``."""
    def hit(t):
        return f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')"
    soft = " + ".join(f"CAST({hit(t.term)} AS INT) * {t.weight}" for t in own_vocabulary() if not t.strict)
    strict = " OR ".join(hit(t.term) for t in own_vocabulary() if t.strict)
    ranked = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    def fits(h, p):
        return f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ranked)
    said = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ranked)
    return f"""WITH a AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
      b AS (SELECT page_id, translate(u, '{ASCII_UPPER}', '{ASCII_LOWER}') AS low,
        CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM a),
      c AS (SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{ASCII_UPPER}', '{ASCII_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b)
    SELECT page_id, host, path, CASE {rule} END AS rule,
      CASE {said} ELSE CASE WHEN {strict} OR ({soft}) >= {MIN_SOFT} THEN 'block' ELSE 'allow' END END AS verdict
    FROM c"""
