"""Print the formatted physical plans of the main operators at a given scale.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pluvio import queries as Q  # noqa: E402
from pluvio.session import build_session  # noqa: E402

SHOWN = ["fact_minute54", "incremental_filter", "merge_upsert_fact", "merge_upsert_fact_broadcast", "observations_lookup"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(app_name="pluvio-plans")
    for name in SHOWN:
        print(f"===== {name}")
        Q.QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
