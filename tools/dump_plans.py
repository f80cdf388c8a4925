"""Write the physical plans of the registered read-only queries to PLANS.md.

    python tools/dump_plans.py [sf_dir]

These are the plans as Catalyst emits them; with AQE on, partition counts
(and, for shuffle joins, the join strategy) may still change at run time.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import warnings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore")

EFFECT_QUERIES = {"history_run", "move_and_verify", "incremental_ingest", "staged_contents", "bronze_job", "history_exactly_once",
                  "tree_listing", "ranged_copies", "landing_files"}


def main(argv):
    from tidemark.workloads import QUERIES
    from tidemark.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "",
           f"Generated by `tools/dump_plans.py` at `{sf_dir}` on `local[8]`. Plans as Catalyst",
           "emits them (AQE may still re-plan partition counts at run time). `*(n)` marks a",
           "whole-stage-codegen stage; explicit broadcasts were size-checked before planning.", ""]
    for name, fn in QUERIES.items():
        if name in EFFECT_QUERIES:
            continue
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        out += [f"## {name}", "", "```", buf.getvalue().strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
