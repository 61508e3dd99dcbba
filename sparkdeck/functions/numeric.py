"""Numeric transforms (log, reciprocal, square root, cube root) and parsing.

Declared behaviour at the domain edges (SURVEY H13-H16), all native:

* ``ln(x)``: NULL for x <= 0 (Spark ``log``)
* ``reciprocal(x)``: NULL for x = 0 (``try_divide``; plain ``/`` raises under ANSI)
* ``sqrt(x)``: NaN for x < 0
* ``cube_root_pow(x)``: ``x ** (1/3)``, NaN for x < 0 (the reference's form);
  ``cube_root(x)`` is the real cube root (``cbrt(-8) = -2``)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_TEXT = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ln(c) -> Column:
    return F.log(_col(c))


def reciprocal(c) -> Column:
    return F.try_divide(F.lit(1.0), _col(c).cast("double"))


def sqrt(c) -> Column:
    return F.sqrt(_col(c))


def cube_root_pow(c) -> Column:
    return F.pow(_col(c), F.lit(1.0 / 3.0))


def cube_root(c) -> Column:
    return F.cbrt(_col(c))


def parse_number(raw: Column, dtype: str, on_bad: str, field: str) -> Column:
    """Parse text to ``dtype``.

    ``on_bad='skip'`` yields NULL for unparsable text (caller drops the row);
    ``on_bad='fail'`` raises, as an unguarded ``parseInt``/``parseDouble`` does.
    Integers must be plain digits (``Integer.parseInt`` rejects ``12.0`` and
    inner blanks); doubles accept what ``Double.parseDouble`` accepts.
    """
    parsed = raw.try_cast(dtype)
    if dtype in ("int", "bigint", "long", "smallint", "tinyint"):
        parsed = F.when(raw.rlike(INT_TEXT), parsed)
    if on_bad == "skip":
        return parsed
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    msg = F.concat(F.lit(f"unparsable {dtype} in field {field}: "), F.coalesce(raw, F.lit("NULL")))
    return F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(msg).cast(dtype))
