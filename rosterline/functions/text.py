"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterline.specs import EMPTY_TOKENS, GENDER_DEFAULT, GENDER_MAP, STRIP_CHARS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_ASCII_WS = "".join(ch for ch in STRIP_CHARS if ord(ch) < 0x80)


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace (the same character set as Python's ``str.strip``).

    A trim over single-byte characters handles nearly every cell; the full-set trim (several times slower per cell)
    only runs when the remaining text still starts or ends with a wider whitespace character.
    """
    return finish_strip(ascii_strip(c))


def ascii_strip(c: str | Column) -> Column:
    """First half of ``strip_ws``: trim single-byte whitespace."""
    return F.btrim(_col(c), F.lit(_ASCII_WS))


def finish_strip(t: str | Column) -> Column:
    """Second half of ``strip_ws``: trim wider whitespace when an edge character is one."""
    t = _col(t)
    # Code point of the first / last character; only a non-ASCII edge can be wide whitespace.
    wide_edge = (F.ascii(F.substring(t, 1, 1)) >= 128) | (F.ascii(F.substring(t, -1, 1)) >= 128)
    return F.when(wide_edge, F.btrim(t, F.lit(STRIP_CHARS))).otherwise(t)


def strip_cell(c: str | Column) -> Column:
    """``strip_ws`` that trims only cells whose first or last character may be whitespace: few do, and comparing the cell and
    its last byte with the range of other ASCII characters costs far less than a trim."""
    c = _col(c)
    last = F.substring(c.cast("binary"), -1, 1)
    plain = (c >= "!") & (c < "\x7f") & (last >= F.lit(bytearray(b"!"))) & (last < F.lit(bytearray(b"\x7f")))
    return F.when(plain, c).otherwise(strip_ws(c))


def null_if_empty_token(t: str | Column) -> Column:
    t = _col(t)
    return F.when(t.isin(*EMPTY_TOKENS), F.lit(None).cast("string")).otherwise(t)


def clean_cell(c: str | Column) -> Column:
    """Stripped text, or null when the stripped text is one of the empty tokens."""
    t = strip_ws(c)
    return F.when(t.isin(*EMPTY_TOKENS), F.lit(None).cast("string")).otherwise(t)


def is_missing(c: str | Column) -> Column:
    """Null or whitespace only."""
    c = _col(c)
    return c.isNull() | (strip_cell(c) == "")


def name_key(c: str | Column) -> Column:
    """Case-folded, stripped name used for lookups against the state."""
    return F.lower(strip_ws(c))


def token_count(c: str | Column) -> Column:
    """Number of whitespace-separated words (0 for null or blank)."""
    t = strip_ws(c)
    return F.when(t.isNull() | (t == ""), F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


def blank_to_default(c: str | Column, default: str) -> Column:
    """Whitespace-only or null → ``default``; any other value is kept as it is (unstripped)."""
    c = _col(c)
    return F.when(is_missing(c), F.lit(default)).otherwise(c)


def normalize_gender(c: str | Column, mapping: dict[str, str] = GENDER_MAP, default: str = GENDER_DEFAULT) -> Column:
    """Map the upper-cased, stripped cell through ``mapping``; everything else (also blank and null) → ``default``."""
    g = F.upper(strip_cell(c))
    expr = None
    for value in dict.fromkeys(mapping.values()):
        keys = [k for k, v in mapping.items() if v == value]
        cond = g.isin(*keys)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))
