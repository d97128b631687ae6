"""Text normalisation.

``normalize_text`` = lower case, strip white space, NFKD and drop combining
marks, collapse white-space runs to one space; NULL stays NULL.

ASCII values (the vast majority of city / state names) never leave the JVM
in spirit: inside each Arrow batch they take a vectorised fast path, and
each distinct non-ASCII value of a batch is normalised once.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() / str.isspace() treat as
# white space (tab, line feed, vertical tab, form feed, carriage return,
# the four information separators, space, next line, no-break space, ogham
# space mark, en quad through hair space, line and paragraph separators,
# narrow no-break space, medium mathematical space, ideographic space).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
_NON_SPACE_WS = WS_CHARS.replace(" ", "")

_WS_RUN = re.compile(r"\s+")


def _to_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim leading / trailing Unicode white space (Spark's one-argument
    ``trim`` only removes U+0020); a character-set trim, no regex."""
    return F.trim(_to_col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Every white-space run -> one space: other white-space characters are
    mapped to spaces first, then runs of spaces are collapsed."""
    spaced = F.translate(_to_col(c), _NON_SPACE_WS, " " * len(_NON_SPACE_WS))
    return F.regexp_replace(spaced, "  +", " ")


def upper_strip(c) -> Column:
    """State codes: upper case, then strip."""
    return strip_ws(F.upper(_to_col(c)))


_COMBINING: re.Pattern | None = None


def _combining_marks() -> re.Pattern:
    """A character class of every code point with a non-zero canonical
    combining class, built once per Python worker from unicodedata, so mark
    removal is one C-level regex pass instead of a Python loop per char."""
    global _COMBINING
    if _COMBINING is None:
        ranges, start, prev = [], None, None
        for cp in range(0x110000):
            if unicodedata.combining(chr(cp)):
                if start is None:
                    start = cp
                prev = cp
            elif start is not None:
                ranges.append((start, prev))
                start = None
        if start is not None:
            ranges.append((start, prev))
        cls = "".join(re.escape(chr(a)) if a == b else f"{re.escape(chr(a))}-{re.escape(chr(b))}"
                      for a, b in ranges)
        _COMBINING = re.compile(f"[{cls}]+")
    return _COMBINING


def _normalize_one(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.lower().strip())
    return _WS_RUN.sub(" ", _combining_marks().sub("", s))


@F.pandas_udf(T.StringType())
def _normalize_nonascii(s: pd.Series) -> pd.Series:
    out = s.copy()
    mask = s.fillna("").str.contains(r"[^\x00-\x7f]", regex=True)
    if mask.any():
        uniq = {v: _normalize_one(v) for v in s[mask].unique()}
        out[mask] = s[mask].map(uniq)
    return out


def _normalize_ascii(c: Column) -> Column:
    # For pure ASCII input NFKD is the identity, so lower + strip + collapse
    # is the whole function: map white space to spaces, trim spaces,
    # collapse runs - all JVM-side.
    spaced = F.translate(F.lower(c), _NON_SPACE_WS, " " * len(_NON_SPACE_WS))
    return F.regexp_replace(F.trim(spaced, F.lit(" ")), "  +", " ")


def normalize_text(c) -> Column:
    """Exact ``normalize_text``: native expression for ASCII values, the
    pandas UDF only for values holding a non-ASCII character.

    The UDF's input is NULL for ASCII rows, so only non-ASCII text crosses
    into Python (a NULL costs a bit in the Arrow batch); ASCII text never
    leaves the JVM."""
    c = _to_col(c)
    non_ascii = c.rlike("[^\\x00-\\x7F]")
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(~non_ascii, _normalize_ascii(c)) \
        .otherwise(_normalize_nonascii(F.when(non_ascii, c)))
