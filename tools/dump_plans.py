"""Write PLANS.md: the final (adaptive) physical plan of every registered
query with an oracle, executed at the given scale, plus the columns and
filters each parquet scan was asked for.

    python tools/dump_plans.py [--sf-dir /root/testdata/sf0.01] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkdeck.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from sparkdeck.session import build_session  # noqa: E402

_ATTR = re.compile(r"#\d+L?")
_CTRL = re.compile(r"[\x00-\x08\x0b-\x1f\x7f]")


def _clean(text: str) -> str:
    """Attribute ids removed; control characters (e.g. the Java trim set) escaped."""
    text = text.replace("\t", "\\t").replace("\r", "\\r")
    return _CTRL.sub(lambda m: f"\\x{ord(m.group(0)):02x}", _ATTR.sub("", text))


def _tree(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if line.startswith("+- == Initial Plan =="):
            break
        line = _clean(line)
        line = re.sub(r"\[[^\[\]]{60,}\]", "[...]", line)
        out.append(line[:160])
    return out


def _scans(plan: str) -> list[str]:
    rows = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        s = m.group(0)
        loc = re.search(r"Location: [^\[]*\[[^\]]*/([a-z_]+)\.parquet", s)
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", s)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
        rows.append(f"{loc.group(1) if loc else '?'}: {schema.group(1) if schema else '?'}"
                    f"{'  pushed ' + _ATTR.sub('', pushed.group(1)) if pushed and pushed.group(1) != '[]' else ''}")
    return sorted(set(rows))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    a = ap.parse_args()
    load_all()
    spark = build_session()
    parts = ["# PLANS — final physical plans of the registered queries", "",
             f"Generated by `tools/dump_plans.py` at `{a.sf_dir}` (`local[8]`, AQE on): each query is executed,",
             "then its final adaptive plan is printed with attribute ids removed. `scans` lists every parquet",
             "scan's read schema (column pruning) and pushed filters.", ""]
    for name in sorted(ORACLES):
        df = QUERIES[name](spark, a.sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "scans:", ""] + [f"* `{s}`" for s in _scans(plan)] + [
            "", "```"] + _tree(plan) + ["```", ""]
    spark.stop()
    with open(a.out, "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
