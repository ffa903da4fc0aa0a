"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: six or seven digits, a dash and a check digit.
ASSET_CODE_PATTERN = r"(\d{6,7}-\d)"

# Unicode white space plus the four separator control characters, the set Python calls white space.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(name: Column | str, collapse_ws: bool = False) -> Column:
    """Upper-cased name without outer blanks; null stays null.

    By default only spaces are trimmed, as SQL TRIM does. With ``collapse_ws`` all outer white space goes
    and each inner run becomes one space.
    """
    text = _col(name).cast("string")
    if not collapse_ws:
        return F.upper(F.trim(text))
    return F.upper(F.trim(F.regexp_replace(text, _BLANKS, " ")))


def asset_code(code: Column | str) -> Column:
    """The asset's core code inside a longer code text; empty where there is none, null for null."""
    return F.regexp_extract(_col(code), ASSET_CODE_PATTERN, 1)
