"""Encoding expressions: map lookup with a default, multi-hot flags to names.

Both are single native expressions (``create_map`` / ``array_compact``), so a
10-entry ordinal map or a 19-flag decode costs one projection, not a join or
a Python call per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_lookup(c, mapping: Mapping, default=-1) -> Column:
    """``mapping.get(value, default)``; NULL input also gives ``default``."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(m[_col(c)], F.lit(default))


def flags_to_names(flag_cols: Sequence, names: Sequence[str], on: str = "1") -> Column:
    """Array of ``names[i]`` for each flag column equal to ``on``, in order."""
    if len(flag_cols) != len(names):
        raise ValueError("one name per flag column")
    picks = [F.when(_col(c) == on, F.lit(n)) for c, n in zip(flag_cols, names)]
    return F.array_compact(F.array(*picks))


def names_to_flags(words: Column, names: Sequence[str]) -> list[Column]:
    """Inverse of ``flags_to_names`` for an array of words: '1'/'0' per name."""
    return [F.when(F.array_contains(words, n), F.lit("1")).otherwise(F.lit("0")).alias(f"flag_{n}")
            for n in names]
