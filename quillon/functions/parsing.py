"""Column expressions for text-to-number parsing.

Python ``int(s.strip())`` and ``float(s.strip())`` are the per-line parsers the
library replaces. These expressions give the same answers on record text while
staying inside whole-stage codegen: a regular-expression guard decides whether
the text is a number, ``try_cast`` converts it, anything else is null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: what counts as an integer / a decimal number after trimming.
INT_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NON_FINITE_PATTERN = r"^[+-]?(?i)(nan|inf|infinity)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(text) -> Column:
    """Without white space (blank, tab, line ends, vertical tab, form feed) at either end."""
    return F.btrim(_c(text), F.lit(" \t\n\u000b\f\r"))


def _number(stripped: Column) -> Column:
    return F.when(stripped.rlike(DECIMAL_PATTERN) | stripped.rlike(NON_FINITE_PATTERN), stripped.try_cast("double"))


def slice_text(value, start: int, end: int) -> Column:
    """Python-style ``line[start:end]`` (0-based, half-open) as a Spark substring."""
    return F.substring(_c(value), start + 1, end - start)


def trimmed_int(t) -> Column:
    """``int(t)`` of a trimmed text or null when it would raise (or not fit in 32 bits)."""
    return F.when(t.rlike(INT_PATTERN), t.try_cast("int"))


def parse_int(text) -> Column:
    """``int(text.strip())`` or null when it would raise (or not fit in 32 bits)."""
    return trimmed_int(strip_ws(text))


def parse_double(text) -> Column:
    """``float(text.strip())`` for decimal and non-finite words, else null."""
    return _number(strip_ws(text))


def trimmed_scaled(t, scale: float, missing: Iterable[str]) -> Column:
    """Of a trimmed text, a missing code gives null, otherwise the number divided by ``scale``."""
    missing = list(missing)
    value = _number(t) / F.lit(float(scale))
    return F.when(t.isin(missing), F.lit(None).cast("double")).otherwise(value) if missing else value


def parse_scaled(text, scale: float, missing: Iterable[str]) -> Column:
    """Trimmed text; a missing code gives null, otherwise the number divided by ``scale``."""
    return trimmed_scaled(strip_ws(text), scale, missing)
