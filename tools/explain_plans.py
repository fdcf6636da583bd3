"""Print the formatted physical plan of headline queries.

Usage: python tools/explain_plans.py [sf_dir] [query ...]
Shows where filters are pushed to the Parquet scan (PushedFilters), which
columns are read (ReadSchema), and where exchanges and broadcasts sit.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from aqarlens.catalog import queries as q  # noqa: E402
from aqarlens.session import session  # noqa: E402

HEADLINE = ("dedup_listings", "clean_listings", "target_encoding_apply", "city_price_summary", "metrics_by_split")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(HEADLINE)
    spark = session()
    for name in names:
        print(f"==================== {name}")
        q.QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
