"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [--no-broadcast] sf_dir query [query ...]

``--no-broadcast`` disables size-based broadcast joins, which shows the
plan a large cluster gets when no side is small (sort-merge joins, AQE
skew handling, runtime filters).
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from baobab.plans.catalog import registry  # noqa: E402
from baobab.session import build_session  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    no_bc = "--no-broadcast" in args
    args = [a for a in args if a != "--no-broadcast"]
    sf = args[0]
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if no_bc else {}
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf=extra)
    for name in args[1:]:
        print("=" * 30, name)
        registry()[name](spark, sf).explain("formatted")
