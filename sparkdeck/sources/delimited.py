"""Delimited record parsing over line DataFrames.

``parse_delimited`` is the one parser: Java-trim the line, drop blank lines,
split with Java's trailing-field rule, test the field count (exact or at
least), then type each field.  Bad numbers either drop the row
(``on_bad='skip'``, the guarded jobs) or fail the job (``on_bad='fail'``, the
unguarded ones).  It is a narrow projection + generator over the scan and
never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.functions.encode import flags_to_names
from sparkdeck.functions.javatext import jsplit, jtrim, literal_sep
from sparkdeck.functions.numeric import parse_number

Field = tuple[str, str]  # (name, spark type name)


def parse_delimited(lines: DataFrame, sep: str, fields: Sequence[Field], arity: int,
                    exact: bool = True, on_bad: str = "fail", trim_fields: bool = True,
                    value_col: str = "value", keep_line: bool = False, trim_line: bool = True,
                    extra: Sequence[tuple[int, str]] = ()) -> DataFrame:
    """Parse ``sep``-delimited lines into typed columns.

    ``fields`` are taken from positions 0..len(fields)-1; ``extra`` adds
    ``(position, name)`` string fields beyond them (e.g. flag columns).
    Rows failing the arity test are dropped (every job does); rows with an
    unparsable number are dropped or fail per ``on_bad``.

    Plan shape: one projection splits each line once; one generator builds
    the typed record; a filter over the generated columns keeps the valid
    ones.  A filter over *projected* fields would be pushed below the
    projection by the optimizer and re-evaluate the split and casts inside
    its condition; over a generator's output it cannot move.
    """
    v = F.col(value_col)
    staged = lines.select(v.alias("_line"), jsplit(jtrim(v) if trim_line else v, literal_sep(sep), sep).alias("_parts"))
    parts = F.col("_parts")
    n = F.size(parts)
    shape_ok = (n == arity if exact else n >= arity) & ~((n == 1) & (F.get(parts, 0) == ""))

    members, typed = [], []
    for i, (name, dtype) in enumerate(fields):
        raw = F.get(parts, i)
        if trim_fields:
            raw = jtrim(raw)
        if dtype == "string":
            members.append(raw.alias(name))
        else:
            # parse only rows of the right shape: the jobs test arity first
            members.append(F.when(shape_ok, parse_number(raw, dtype, on_bad, name)).alias(name))
            typed.append(name)
    for pos, name in extra:
        raw = F.get(parts, pos)
        members.append((jtrim(raw) if trim_fields else raw).alias(name))
    if keep_line:
        members.append(F.col("_line").alias("line"))
    members.append(shape_ok.alias("_ok"))
    names = [f for f, _ in fields] + [e for _, e in extra] + (["line"] if keep_line else [])

    # One record per line from a generator; the validity filter reads the
    # generated columns, so it stays above the generator (not pushed into
    # the split) and runs in whole-stage codegen (no lambda).
    records = staged.select(F.inline(F.array(F.struct(*members))))
    ok: Column = F.col("_ok")
    if on_bad == "skip":
        for t in typed:
            ok = ok & F.col(t).isNotNull()
    return records.filter(ok).select(*names)


@dataclass(frozen=True)
class Layout:
    """One record kind of a mixed input: lines containing ``marker`` are
    split on ``sep`` and typed by ``fields`` (positions 0..n-1)."""

    kind: str
    marker: str
    sep: str
    fields: Sequence[Field]
    arity: int
    exact: bool = True
    on_bad: str = "skip"
    trim_line: bool = True


def parse_by_content(lines: DataFrame, layouts: Sequence[Layout], value_col: str = "value") -> DataFrame:
    """A4 in one pass: each line takes the first layout whose marker it
    contains; output ``kind`` plus the union of all layouts' fields (NULL
    where a field is not part of the line's layout).

    The input is scanned once, as one mapper read both files; filtering the
    same lines once per kind would scan it once per kind.  Fields of the
    same name in several layouts must have the same type."""
    v = F.col(value_col)
    kind = None
    for lay in layouts:
        cond = v.contains(lay.marker)
        kind = F.when(cond, F.lit(lay.kind)) if kind is None else kind.when(cond, F.lit(lay.kind))
    split = None
    for lay in layouts:
        line = jtrim(F.col("_line")) if lay.trim_line else F.col("_line")
        part = jsplit(line, literal_sep(lay.sep), lay.sep)
        split = (F.when(F.col("_kind") == lay.kind, part) if split is None
                 else split.when(F.col("_kind") == lay.kind, part))
    staged = lines.select(v.alias("_line"), kind.alias("_kind")).select("_kind", split.alias("_parts"))
    parts = F.col("_parts")
    n = F.size(parts)
    not_blank = ~((n == 1) & (F.get(parts, 0) == ""))

    shape, exprs, checks = {}, {}, []
    for lay in layouts:
        ok = (F.col("_kind") == lay.kind) & (n == lay.arity if lay.exact else n >= lay.arity) & not_blank
        shape[lay.kind] = ok
        typed_ok = ok
        for i, (name, dtype) in enumerate(lay.fields):
            raw = jtrim(F.get(parts, i))
            val = raw if dtype == "string" else parse_number(raw, dtype, lay.on_bad, name)
            exprs.setdefault(name, []).append((ok, val, dtype))
            if dtype != "string" and lay.on_bad == "skip":
                typed_ok = typed_ok & val.isNotNull()
        checks.append(typed_ok)
    members = [F.col("_kind").alias("kind")]
    for name, alts in exprs.items():
        e = None
        for ok, val, dtype in alts:
            e = F.when(ok, val) if e is None else e.when(ok, val)
        members.append(e.cast(alts[0][2]).alias(name))
    valid = checks[0]
    for c in checks[1:]:
        valid = valid | c
    members.append(valid.alias("_ok"))
    records = staged.select(F.inline(F.array(F.struct(*members))))
    return records.filter(F.col("_ok")).drop("_ok")


# Record layouts of the rating / user / item files.
RATING_FIELDS: list[Field] = [("user_id", "bigint"), ("item_id", "bigint"), ("rating", "double"), ("ts", "bigint")]
USER_FIELDS: list[Field] = [("user_id", "bigint"), ("age", "int"), ("gender", "string"),
                            ("occupation", "string"), ("zip", "string")]
USER_TEXT_FIELDS: list[Field] = [(n, "string" if n == "age" else t) for n, t in USER_FIELDS]
ITEM_HEAD_FIELDS: list[Field] = [("item_id", "bigint"), ("title", "string"), ("release_date", "string"),
                                 ("video_date", "string"), ("url", "string")]


def parse_tab_ratings(lines: DataFrame, on_bad: str = "skip") -> DataFrame:
    """``user<TAB>item<TAB>rating<TAB>ts``; at least 3 fields, guarded parse."""
    return parse_delimited(lines, "\t", RATING_FIELDS[:3], arity=3, exact=False, on_bad=on_bad)


def parse_pipe_users(lines: DataFrame, on_bad: str = "skip") -> DataFrame:
    """``id|age|gender|occupation|zip``, exactly 5 fields; zip stays text."""
    return parse_delimited(lines, "|", USER_FIELDS, arity=5, exact=True, on_bad=on_bad)


def parse_rated_pairs(lines: DataFrame, on_bad: str = "skip") -> DataFrame:
    """(user_id, item_id) of rating lines; the rating itself is not read, so a
    bad one does not cost the row."""
    return parse_delimited(lines, "\t", RATING_FIELDS[:2], arity=3, exact=False, on_bad=on_bad)


def parse_user_texts(lines: DataFrame, on_bad: str = "skip") -> DataFrame:
    """Users of jobs that do not read the age (it may be any text)."""
    return parse_delimited(lines, "|", USER_TEXT_FIELDS, arity=5, exact=True, on_bad=on_bad)


def parse_item_titles(lines: DataFrame, on_bad: str = "skip") -> DataFrame:
    """(item_id, title) of item lines with at least these two fields."""
    return parse_delimited(lines, "|", ITEM_HEAD_FIELDS[:2], arity=2, exact=False, on_bad=on_bad)


def parse_items(lines: DataFrame, category_names: Sequence[str], on_bad: str = "skip") -> DataFrame:
    """``id|title|date|video date|url|flag...``; at least 5 + n fields;
    the flags decode to ``categories: array<string>`` in flag order."""
    head = len(ITEM_HEAD_FIELDS)
    flag_cols = [f"_flag{i}" for i in range(len(category_names))]
    out = parse_delimited(lines, "|", ITEM_HEAD_FIELDS, arity=head + len(category_names), exact=False,
                          on_bad=on_bad, extra=[(head + i, c) for i, c in enumerate(flag_cols)])
    return out.select(*[n for n, _ in ITEM_HEAD_FIELDS],
                      flags_to_names(flag_cols, category_names).alias("categories"))


# A mixed input of rating lines (tab) and user lines (pipe), tab tested first.
RATING_USER_LAYOUTS = (Layout("R", "\t", "\t", RATING_FIELDS[:3], arity=3, exact=False),
                       Layout("U", "|", "|", USER_FIELDS, arity=5, exact=True))
