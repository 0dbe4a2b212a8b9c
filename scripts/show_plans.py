"""Print the physical plans of the headline operators over written tables.

Usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from postlake.operators import gold as G  # noqa: E402
from postlake.operators import topk as K  # noqa: E402
from postlake.operators.bronze import bronze_submissions  # noqa: E402
from postlake.operators.silver import silver_submissions  # noqa: E402
from postlake.plans.chain import raw_fx  # noqa: E402
from postlake.schemas import TABLES  # noqa: E402
from postlake.session import local_session  # noqa: E402
from postlake.sinks.tables import read_table, replace_partitions  # noqa: E402


def plan(df) -> str:
    """The plan that ran, after adaptive re-planning."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0].rstrip()
    text = re.sub(r"#\d+L?", "", text)                      # attribute ids
    text = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\], ", "", text)  # temp paths
    return "\n".join(l if "FileScan" in l else l[:220] for l in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(4, 16)
    work = tempfile.mkdtemp(prefix="postlake-plans-")
    days = [dt.date(2025, 6, 29) + dt.timedelta(days=i) for i in range(7)]
    replace_partitions(raw_fx(spark, sf_dir), f"{work}/raw", days)
    raw = read_table(spark, f"{work}/raw", TABLES["raw_submissions"][0])
    replace_partitions(silver_submissions(bronze_submissions(raw)), f"{work}/silver", days)
    silver = read_table(spark, f"{work}/silver", TABLES["silver_submissions"][0])
    shown = {
        "bronze (dedup + QC) from the raw table": bronze_submissions(raw),
        "silver from bronze rows": silver_submissions(bronze_submissions(raw)),
        "gold_topic_trends from the silver table": G.gold_topic_trends(silver),
        "gold_author_profiles from the silver table": G.gold_author_profiles(silver),
        "gold_top_daily from the silver table": K.gold_top_daily(silver),
        "doc_top_authors_daily from the silver table": G.doc_top_authors_daily(silver),
        "one day of silver (partition pruning)": silver.filter("ds = DATE'2025-07-01'").select("content_id"),
    }
    print("# Physical plans (final, after adaptive re-planning, on small tables)\n")
    print("Generated by `python scripts/show_plans.py`; attribute ids and temp paths removed.\n")
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
