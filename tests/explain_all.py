"""Write PLANS.md: the physical plan of every registered query.

Usage: python tests/explain_all.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-plans-"))
    import __spark_entry__ as E
    out = ["# Physical plans", "",
           f"Every registered query at `{sf_dir}` on local[8], before execution (AQE may",
           "still turn sort-merge joins into broadcasts and coalesce partitions at run time).",
           "Temporary folders of the writing queries are shown as `<scratch>`.", ""]
    for name, q in E.queries().items():
        df = q(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/tmp/[^\]\s,]+", "<scratch>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
