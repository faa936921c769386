"""Print the formatted physical plan of registered batch queries.

    python tools/explain.py [--sf /root/testdata/sf0.01] name [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from salespark.plans.queries import QUERIES
    from salespark.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in a.names:
        print(f"==== {name}")
        QUERIES[name].run(spark, a.sf).explain("formatted")


if __name__ == "__main__":
    main()
