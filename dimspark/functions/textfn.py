"""Text expressions.

Each one is a composition of Spark SQL string functions, so it runs in
the JVM and keeps whole-stage codegen; nothing here calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimspark.functions.common import as_col

# Words for title case: a run of letters, or a run of anything else.
_TITLE_TOKENS = r"(\p{L}+|[^\p{L}]+)"


def py_title(s) -> Column:
    """Python ``str.title()``: a capital after every non-letter.

    ``initcap`` only starts a word after a space, so D'ALENE would become
    D'alene; Python gives D'Alene and WINSTON-SALEM -> Winston-Salem.
    """
    tokens = F.regexp_extract_all(F.lower(as_col(s)), F.lit(_TITLE_TOKENS), 1)
    cased = F.transform(
        tokens,
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)),
    )
    return F.when(as_col(s).isNotNull(), F.array_join(cased, ""))


def split_part(s, sep: str, index: int) -> Column:
    """``s.split(sep)[i]`` with Python indexing (0 first, -1 last)."""
    parts = F.split(as_col(s), _regex_quote(sep))
    return F.element_at(parts, index + 1 if index >= 0 else index)


def last_part_len(s, sep: str) -> Column:
    """F8 helper: length of the last ``sep``-separated part."""
    return F.length(split_part(s, sep, -1))


def blank_to_null(s) -> Column:
    """BLANKSASNULL / EMPTYASNULL: '' and all-whitespace -> NULL."""
    c = as_col(s)
    return F.when(F.trim(c) != F.lit(""), c)


def truncate_chars(s, width: int) -> Column:
    """TRUNCATECOLUMNS to ``width`` characters.

    The warehouse counts bytes (``truncate_bytes``); this counts characters.
    For ASCII text both agree.
    """
    return F.left(as_col(s), F.lit(width))


def truncate_bytes(s, width: int) -> Column:
    """TRUNCATECOLUMNS as the warehouse counts: at most ``width`` bytes
    of UTF-8, cut between characters. Built-ins only.

    The cut is the last place up to ``width`` whose next byte does not go
    on with a character (80 to BF); a character has at most four bytes, so
    one of the last four places is it.
    """
    if width < 0:
        raise ValueError("width must not be negative")
    c = as_col(s)
    raw = c.cast("binary")

    def goes_on(k: int) -> Column:
        return F.hex(F.substring(raw, k + 1, 1)).between("80", "BF")

    cut = F.lit(max(width - 3, 0))
    for k in range(max(width - 2, 0), width + 1):
        cut = F.when(goes_on(k), cut).otherwise(F.lit(k))
    return F.when(F.octet_length(c) <= width, c).otherwise(F.substring(raw, F.lit(1), cut).cast("string"))


def regex_pairs(s, pattern: str) -> Column:
    """Every match of a two-group regex as an array of (code, label).

    Like ``re.findall`` with two groups: all non-overlapping matches, in
    order.
    """
    c = as_col(s)
    codes = F.regexp_extract_all(c, F.lit(pattern), 1)
    labels = F.regexp_extract_all(c, F.lit(pattern), 2)
    return F.arrays_zip(codes.alias("code"), labels.alias("label"))


def _regex_quote(sep: str) -> str:
    out = []
    for ch in sep:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)
