"""Text expressions (JVM side): tokens, blank runs, lines, slugs, anchors.

Regular expressions are written so Java's engine and RE2 (used by the DuckDB
oracles) read them the same way: no look-around, Unicode classes spelled out
as ``\\p{L}`` / ``\\p{N}`` instead of relying on ``\\w``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The native tokenizer. A token is a run of letters, digits and
# underscores, or one other non-space character; each piece carries the
# whitespace that follows it so that concatenating pieces gives the text back.
WS = r"[ \t\n\x0B\f\r]"
WORD = r"[\p{L}\p{N}_]+"
SYMBOL = r"[^\p{L}\p{N}_ \t\n\x0B\f\r]"
TOKEN = f"{WORD}|{SYMBOL}"
PIECE = f"(?:{WORD}|{SYMBOL}){WS}*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(WORD), 0)


def tokens(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(TOKEN), 0)


def pieces(text) -> Column:
    """Token pieces with their trailing whitespace (leading whitespace dropped)."""
    return F.regexp_extract_all(_c(text), F.lit(PIECE), 0)


def count_tokens(text) -> Column:
    """F3 with the native tokenizer; null text counts 0."""
    return F.coalesce(F.size(tokens(text)), F.lit(0))


def collapse_blank_runs(text) -> Column:
    """runs of two or more newlines become one blank line, then strip."""
    t = F.regexp_replace(_c(text), r"\n\n+", "\n\n")
    return F.regexp_replace(t, r"(?U)^\s+|\s+$", "")


def py_strip(text) -> Column:
    """Python ``str.strip()``: Unicode-aware whitespace trim."""
    return F.regexp_replace(_c(text), r"(?U)^\s+|\s+$", "")


_DIGITS: tuple[str, str] | None = None


def _unicode_digits() -> tuple[str, str]:
    """Every non-ASCII Unicode decimal digit and its ASCII value, from the
    Unicode database (a rule, not a hand-written table)."""
    global _DIGITS
    if _DIGITS is None:
        import sys
        import unicodedata
        src, dst = [], []
        for cp in range(128, sys.maxunicode + 1):
            ch = chr(cp)
            if unicodedata.category(ch) == "Nd":
                src.append(ch)
                dst.append(str(unicodedata.digit(ch)))
        _DIGITS = ("".join(src), "".join(dst))
    return _DIGITS


def try_double(text) -> Column:
    """Python ``float(text)`` or null: surrounding whitespace, any Unicode
    decimal digits and underscores between digits are accepted as float()
    accepts them."""
    src, dst = _unicode_digits()
    t = F.translate(py_strip(text), src, dst)
    t = F.regexp_replace(t, r"(?<=[0-9])_(?=[0-9])", "")
    return t.try_cast("double")


def line_count(text) -> Column:
    """A10: number of lines as Python's ``str.splitlines`` counts them for
    ``\\n`` separated text (a final newline does not open a new line)."""
    t = _c(text)
    n = F.size(F.split(t, "\n", -1))
    return F.when(t.isNull() | (t == ""), F.lit(0)).otherwise(
        F.when(t.endswith("\n"), n - 1).otherwise(n))


def line_range(text, start: int, end: int, legacy: bool = False) -> Column:
    """lines ``[start, end)``, 0-based, joined by one newline.

    ``legacy=True`` reproduces the reference, which joins lines that still end
    in ``\\n`` with ``\\n`` (every inner line break doubled, and a trailing
    newline when the last picked line had one)."""
    t = _c(text)
    segs = F.split(t, "\n", -1)
    lines = F.when(t.endswith("\n"), F.slice(segs, 1, F.size(segs) - 1)).otherwise(segs)
    sl = F.slice(lines, start + 1, max(end - start, 0))
    if not legacy:
        return F.array_join(sl, "\n")
    tail = F.when((F.size(sl) > 0) & (F.lit(start) + F.size(sl) < F.size(segs)), F.lit("\n")).otherwise(F.lit(""))
    return F.concat(F.array_join(sl, "\n\n"), tail)


def url_slug(url) -> Column:
    """drop the scheme, ``/`` -> ``_``, add ``.txt``."""
    no_scheme = F.regexp_replace(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.concat(F.translate(no_scheme, "/", "_"), F.lit(".txt"))


def anchor(path) -> Column:
    """``file-`` + lower-cased path with ``/`` and ``.`` turned into ``-``."""
    return F.concat(F.lit("file-"), F.translate(F.lower(_c(path)), "/.", "--"))
