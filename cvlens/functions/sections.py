"""Section detection with native span arrays.

A header pattern's matches are found left to right without overlap (Python
``finditer`` / Java ``find``). ``split`` yields the text between matches and
``regexp_extract_all`` the matches, so folding their lengths gives each
match's start. A section starts at the end of the first match of its first
matching pattern and ends at the nearest later match start (strictly after
that end) of any pattern of any section, else at the end of the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cvlens.functions.text import strip_ws

# Default header patterns per section (case-insensitive, unanchored).
DEFAULT_SECTION_PATTERNS: dict[str, list[str]] = {
    "skills": [r"(?i)(skills?|technical skills?|core competencies)"],
    "experience": [r"(?i)(experience|work history|employment)"],
    "education": [r"(?i)(education|academic background|qualifications)"],
    "projects": [r"(?i)(projects?|portfolio)"],
}

SECTION_NAMES = ["skills", "experience", "education", "projects"]


def _later_start(pairs: Column, after: Column) -> Column:
    """The first match start beyond ``after``: one pass over (gap, match) pairs, nothing is built up."""
    init = F.struct(F.lit(0).alias("pos"), F.lit(None).cast("int").alias("hit"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["g"])
        return F.struct((start + F.length(x["m"])).alias("pos"),
                        F.coalesce(acc["hit"], F.when(start > after, start)).alias("hit"))

    return F.aggregate(pairs, init, step, lambda acc: acc["hit"])


# Alternatives of plain words, in any case: where a match may begin is known from their first letters.
_PLAIN = re.compile(r"\(\?i\)(?:\(([a-z][a-z :?|]*)\)|([a-z][a-z :?]*))")


def _quick(pattern: str) -> str:
    """A pattern of the same matches that looks at the first letter before it tries the alternatives."""
    plain = _PLAIN.fullmatch(pattern)
    words = (plain[1] or plain[2]).split("|") if plain else []
    if not words or not all(re.match(r"[a-z](?!\?)", w) for w in words):
        return pattern
    return f"(?=[{''.join(sorted({c for w in words for c in (w[0], w[0].upper())}))}]){pattern}"


def add_sections(df, text_col: str, patterns: dict[str, list[str]] | None = None,
                 names: list[str] | None = None, prefix: str = ""):
    """``df`` plus one column per section of ``text_col``.

    Each pattern passes over the text twice (matches, and the text between
    them), in a projection that all sections share.
    """
    patterns = DEFAULT_SECTION_PATTERNS if patterns is None else patterns
    names = SECTION_NAMES if names is None else names
    text = F.col(text_col)
    uniq = list(dict.fromkeys(p for ps in patterns.values() for p in ps))
    found = {p: f"__m{i}" for i, p in enumerate(uniq)}
    between = {p: f"__g{i}" for i, p in enumerate(uniq)}
    df = df.select("*", *[F.regexp_extract_all(text, F.lit(_quick(p)), 0).alias(found[p]) for p in uniq],
                   *[F.split(text, _quick(p), -1).alias(between[p]) for p in uniq])
    pairs = {p: F.arrays_zip(F.slice(between[p], 1, F.size(found[p])).alias("g"), F.col(found[p]).alias("m")) for p in uniq}
    firsts = {p: F.when(F.size(found[p]) > 0, F.length(F.element_at(between[p], 1)) + F.length(F.element_at(found[p], 1)))
              for p in uniq}
    wanted = [n for n in names if patterns.get(n)]
    df = df.select("*", *[pairs[p].alias(f"__p{i}") for i, p in enumerate(uniq)],
                   *[F.coalesce(*[firsts[p] for p in patterns[n]]).alias(f"__s_{n}") for n in wanted])
    cols = []
    for name in names:
        if name not in wanted:
            cols.append(F.lit("").alias(prefix + name))
            continue
        st = F.col(f"__s_{name}")
        later = [_later_start(F.col(f"__p{i}"), st) for i in range(len(uniq))]
        end = F.coalesce(F.least(*later) if len(later) > 1 else later[0], F.length(text))
        body = strip_ws(F.substring(text, st + 1, end - st))
        cols.append(F.when(st.isNull(), F.lit("")).otherwise(body).alias(prefix + name))
    extra = [*found.values(), *between.values(), *(f"__p{i}" for i in range(len(uniq))), *(f"__s_{n}" for n in wanted)]
    return df.select("*", *cols).drop(*extra)


# ---- SQL spelling (DuckDB) for the oracles --------------------------------

def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_starts(t: str, p: str) -> str:
    m = "regexp_extract_all(%s, %s, 0)" % (t, _sql_lit(p))
    g = "string_split_regex(%s, %s)" % (t, _sql_lit(p))
    return ("list_transform(range(1, len(%(m)s) + 1), lambda i: "
            "CAST(coalesce(list_sum(list_transform(%(g)s[1:i], lambda x: length(x))), 0) + "
            "coalesce(list_sum(list_transform(%(m)s[1:i-1], lambda x: length(x))), 0) AS BIGINT))"
            ) % {"m": m, "g": g}


def section_sql(t: str, name: str, patterns: dict[str, list[str]] | None = None) -> str:
    """DuckDB expression for one section of text expression ``t``."""
    patterns = DEFAULT_SECTION_PATTERNS if patterns is None else patterns
    if name not in patterns or not patterns[name]:
        return "''"
    firsts = []
    for p in patterns[name]:
        firsts.append("CASE WHEN regexp_matches(%s, %s) THEN length(string_split_regex(%s, %s)[1]) "
                      "+ length(regexp_extract(%s, %s, 0)) END"
                      % (t, _sql_lit(p), t, _sql_lit(p), t, _sql_lit(p)))
    st = "coalesce(%s)" % ", ".join(firsts) if len(firsts) > 1 else firsts[0]
    all_patterns = list(dict.fromkeys(p for ps in patterns.values() for p in ps))
    later = ["list_filter(%s, lambda s: s > %s)[1]" % (_sql_starts(t, p), st) for p in all_patterns]
    end = "coalesce(least(%s), length(%s))" % (", ".join(later), t)
    body = "substring(%s, %s + 1, %s - %s)" % (t, st, end, st)
    from cvlens.functions.text import strip_ws_sql
    return "CASE WHEN %s IS NULL THEN '' ELSE %s END" % (st, strip_ws_sql(body))
