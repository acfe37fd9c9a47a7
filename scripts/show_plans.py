"""Print the physical plans of selected catalog queries, lines cut at 160 characters, into docs/PLANS.md.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from periodlens.plans.catalog import QUERIES  # noqa: E402
from periodlens.session import local_session  # noqa: E402

SHOWN = ("compare_full", "denormalize", "name_map", "compare_total", "numeric_summary", "exclude_groups", "top_split", "keep_groups",
         "trend_partials", "wrapped_records")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    out = ["# Physical plans", "",
           f"Plans of selected queries on `{sf_dir}` before adaptive execution (`python scripts/show_plans.py`).",
           "Look for `PartitionFilters` / `PushedFilters` / `ReadSchema` on scans and partial `HashAggregate`s before",
           "each `Exchange`; repeated subplans are computed once at run time (exchange reuse).", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        out += [f"## {name}", "", "```", "\n".join(line[:160] for line in buf.getvalue().rstrip().splitlines()), "```", ""]
    os.makedirs("docs", exist_ok=True)
    with open(os.path.join("docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
