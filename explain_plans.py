"""Write PLANS.md: the physical plan tree of every registered batch query.

For each query: the formatted plan's tree, the number of shuffles, and the
columns each scan reads. Run: python explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txpulse.plans.queries import QUERIES  # noqa: E402
from txpulse.session import build_session  # noqa: E402

# queries whose callables run jobs before returning (they write or stream)
EAGER = {"state_restore", "snapshot_upsert", "state_export"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = [
        "# Physical plans",
        "",
        f"Generated by `explain_plans.py` on `{os.path.basename(sf_dir)}` with AQE on "
        "(initial plans; AQE may coalesce partitions at run time).",
        "",
    ]
    for name, fn in QUERIES.items():
        if name in EAGER or name.startswith(("stream_", "live_")):
            continue
        text = fn(spark, sf_dir)._jdf.queryExecution().explainString(mode)
        tree = text.split("\n\n")[0]
        shuffles = len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))
        schemas = sorted(set(re.findall(r"ReadSchema: (.*)", text)))
        out += [f"## {name}", "", f"shuffles: {shuffles}", ""]
        out += [f"- reads `{s}`" for s in schemas]
        out += ["", "```", tree, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
