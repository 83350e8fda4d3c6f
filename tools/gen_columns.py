"""Regenerate shopmart/plans/columns.py from the Spark schemas of every query.

    python tools/gen_columns.py [sf_dir]

The oracle SQL casts each output column by name, so it needs the column
list of every registered query; tests/test_oracle.py fails if this file is
out of date.
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from shopmart.plans.catalog import REGISTRY, run  # noqa: E402
from shopmart.session import local_session  # noqa: E402

HEADER = '''"""Output columns of every registered query (generated from the Spark schemas;
tests/test_oracle.py keeps it in sync)."""

COLUMNS = {
'''


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    lines = [f"    {name!r}: {run(spark, sf_dir, name).columns!r},\n" for name in REGISTRY]
    with open("shopmart/plans/columns.py", "w") as out:
        out.write(HEADER + "".join(lines) + "}\n")
    print(f"{len(lines)} queries")


if __name__ == "__main__":
    main()
