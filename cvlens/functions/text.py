"""Text cleaning as native Column expressions (no UDF, stays in codegen).

Python's ``\\s`` and ``str.strip()`` treat 29 code points as white space;
Java's ``\\s`` only six and Spark's ``trim`` only the space. Every pattern here
spells the class out, so Java (Spark) and RE2 (the SQL oracle) agree with the
reference's Python semantics. ``\\z`` anchors the true end of the string (Java's
``$`` also matches before a trailing line break).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space code points of Python's str.isspace(),
# written as a regex class body valid in both Java and RE2.
WS_NO_NL = (
    r"\t\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = r"\n" + WS_NO_NL

# Characters kept by clean_text (letters, digits, white space
# and the punctuation . , ! ? ; : - ' " ( ) [ ] / @).
KEEP_CLASS = r"a-zA-Z0-9" + WS + r".,!?;:\-'" + '"' + r"()\[\]/@"

# The same white space as literal characters (for btrim / SQL trim).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")

DISALLOWED_RUN = "[^" + KEEP_CLASS + "]+"
BLANK_LINES = r"\n[" + WS + r"]*\n+"
SPACE_TAB_RUN = r"[ \t]+"
LINE_EDGES = "[" + WS_NO_NL + r"]*\n[" + WS_NO_NL + "]*"
OUTER_WS = "^[" + WS + "]+|[" + WS + r"]+\z"
WS_RUN = "[" + WS + "]+"

# Java tests a class range by range; a look ahead passes over what most of a text is, where no match can begin.
NO_DISALLOWED_START = "(?![a-z ])(?![A-Z0-9.,])"
NO_EDGE_START = "(?! ?[!-~])"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: drop leading and trailing white space (a character-set trim)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def collapse_ws(col) -> Column:
    """Python ``" ".join(s.split())``: trim, then one space per white-space run."""
    return F.regexp_replace(strip_ws(col), WS_RUN, " ")


def clean_text(col) -> Column:
    """Keep letters, digits and basic punctuation, normalise white space.

    1. runs of other characters -> one space; 2. a blank-line run -> two line
    breaks; 3. runs of spaces/tabs -> one space; 4. strip every line; 5. strip
    the whole text. Null or empty input gives ''.
    """
    t = F.coalesce(_c(col), F.lit(""))
    t = F.regexp_replace(t, NO_DISALLOWED_START + DISALLOWED_RUN, " ")
    t = F.regexp_replace(t, BLANK_LINES, "\n\n")
    t = F.regexp_replace(t, SPACE_TAB_RUN, " ")
    # Removing white space around every line break strips each line; the
    # final strip handles the first line's start and the last line's end.
    t = F.regexp_replace(t, NO_EDGE_START + LINE_EDGES, "\n")
    return strip_ws(t)


def split_words(col) -> Column:
    """Python ``s.split()``: white-space separated tokens, no empty tokens."""
    return F.array_remove(F.split(F.coalesce(_c(col), F.lit("")), WS_RUN, -1), "")


def normalize_newlines(col) -> Column:
    """Python text-mode reading: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    return F.regexp_replace(_c(col), "\r\n?", "\n")


def decode_text(content) -> Column:
    """Bytes -> text: UTF-8 when valid, otherwise Latin-1 (never fails)."""
    content = _c(content)
    return normalize_newlines(
        F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8"))
        .otherwise(F.decode(content, "ISO-8859-1")))


# SQL spellings of the same steps, used by the DuckDB oracles.
def clean_text_sql(expr: str) -> str:
    def rr(e, pat, rep):
        return "regexp_replace(%s, '%s', '%s', 'g')" % (e, pat.replace("'", "''"), rep)
    t = "coalesce(%s, '')" % expr
    t = rr(t, DISALLOWED_RUN, " ")
    t = rr(t, BLANK_LINES, "\n\n")
    t = rr(t, SPACE_TAB_RUN, " ")
    t = rr(t, LINE_EDGES, "\n")
    return strip_ws_sql(t)


def ws_chars_sql() -> str:
    return "(" + " || ".join("chr(%d)" % ord(c) for c in WS_CHARS) + ")"


def strip_ws_sql(expr: str) -> str:
    return "trim(%s, %s)" % (expr, ws_chars_sql())
