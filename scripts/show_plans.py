"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python scripts/show_plans.py [sf_dir]
Only the operator trees and the scan details (pushed filters, read schema,
partition filters) are kept, so the file shows what each query shuffles,
broadcasts and reads.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
import tempfile
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))

HEADLINE = [
    "enrich", "average_speed", "avg_speed_gear", "merge_average_speed",
    "incremental_filter", "purchase_enriched", "products_purchase_count",
    "check_unique", "day_activity", "json_map_total", "preview_limit",
]
KEEP = re.compile(r"^(Output|PushedFilters|PartitionFilters|ReadSchema|Arguments|Join type|Keys|Left keys|Right keys)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from paddock.plans.registry import QUERIES
    from paddock.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plans-ckpt-"))
    out = [f"# Physical plans of the headline queries ({Path(sf_dir).name}, Spark {spark.version})\n",
           "Generated by `scripts/show_plans.py`; before execution (AQE may still coalesce "
           "partitions or split skewed ones at run time).\n"]
    for name in HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        parts = text.split("\n\n")
        tree = parts[0].replace("== Physical Plan ==\n", "")
        details = []
        for block in parts[1:]:
            lines = block.strip().splitlines()
            if not lines or not lines[0].startswith("("):
                continue
            head = lines[0]
            if not any(k in head for k in ("Scan", "Exchange", "Join", "HashAggregate", "TakeOrdered")):
                continue
            kept = [ln for ln in lines[1:] if KEEP.match(ln)]
            details.append("\n".join([head] + kept))
        out.append(f"## {name}\n\n```\n{tree.rstrip()}\n```\n\n```\n" + "\n\n".join(details) + "\n```\n")
    (REPO / "docs").mkdir(exist_ok=True)
    (REPO / "docs" / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
