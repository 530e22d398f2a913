"""Write the physical plans of the headline queries to PLANS.md.

    python tools/plans.py [sf_dir]

For each query: the formatted plan's operator tree plus a one-line digest
(exchanges, broadcasts, partial window limits, scans with their read schema).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata import schemas as S  # noqa: E402
from strata.plans import checks, jobs  # noqa: E402
from strata.session import build_session  # noqa: E402

NAMES = ["either_key_join", "arg_min_first", "arg_min_ties", "group_min", "insert_ignore", "upsert_some",
         "tag_lookup", "constraint_report", "date_functions"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def digest(text: str) -> str:
    tree, details = text.split("\n\n")[0], text
    n_bc = len(re.findall(r"BroadcastExchange \(", tree))
    n_ex = len(re.findall(r"Exchange \(", tree)) - n_bc
    n_wgl = len(re.findall(r"WindowGroupLimit \(", tree))
    n_partial = len(re.findall(r"Arguments: .*, Partial", details))
    n_scan = len(re.findall(r"Scan parquet", tree))
    return (f"shuffle exchanges: {n_ex}, broadcasts: {n_bc}, window group limits: {n_wgl} "
            f"({n_partial} partial, before a shuffle), parquet scans: {n_scan}")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` at `{sf}` (AQE on; the final plan may coalesce or",
           "switch join strategy at run time).", ""]
    items = [(n, checks.QUERIES[n](spark, sf)) for n in NAMES]
    r = checks._refresh(spark, sf, "conform_leaderboards")
    rd = r.store.read
    items.append(("totd step (X9 batch, as the runner writes it)",
                  jobs.totd_batch(rd(S.CONFORM_TMX), rd(S.CONFORM_TMIO), rd(S.CONFORM_TMIO_LEADERBOARDS))))
    for name, df in items:
        text = plan_text(df)
        reads = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
        pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", text)))
        out += [f"## {name}", "", digest(text), "", "```", text.split("\n\n")[0].strip(), "```", "",
                "Read schemas: " + "; ".join(f"`{x}`" for x in reads), "",
                "Pushed filters: " + "; ".join(f"`{x}`" for x in pushed), ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
