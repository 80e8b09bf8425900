"""Print the formatted physical plan of registered queries.

    python tools/explain.py [--sf /root/testdata/sf0.01] name [name ...]

Shows PushedFilters / PartitionFilters / ReadSchema of every scan, the join
strategies Catalyst picked and every Exchange (shuffle).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans import QUERIES, load_all  # noqa: E402
from quarry.session import get_spark  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    load_all()
    spark = get_spark()
    for name in args.names:
        print(f"===== {name}")
        QUERIES[name](spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main()
