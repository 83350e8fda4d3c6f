"""How the jobs scale: the sf0.1 raw lines replicated k times with shifted keys.

    python tools/scale_probe.py [sf_dir] [k ...]

Copy i of every raw line gets its order, user, courier and store keys
shifted by i × offset (items and the calendar stay shared), so orders,
users and stores grow k-fold like a bigger shop.  Times run_etl and both
marts for each k and prints one JSON line; with ``PLANS=1`` it also prints
the join strategies chosen at the largest k.
"""

from __future__ import annotations

import io
import json
import os
import re
import sys
import tempfile
import time
from contextlib import redirect_stdout

from pyspark.sql import functions as F

sys.path.insert(0, ".")

from shopmart.contracts import CORE, RAW  # noqa: E402
from shopmart.plans import pipeline  # noqa: E402
from shopmart.session import local_session  # noqa: E402
from shopmart.sources.fixture import raw_order_lines  # noqa: E402
from shopmart.sources.io import Target, read_table, write_table  # noqa: E402

OFFSET = 10 ** 9


def replicated(raw, k: int):
    copies = raw.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    shift = F.col("_copy").cast("bigint") * F.lit(OFFSET)
    return copies.withColumns({
        "order_id": F.col("order_id") + shift,
        "user_id": F.col("user_id") + shift,
        "driver_id": F.col("driver_id") + shift,
        "store_id": F.col("store_id") + shift,
    }).drop("_copy")


def strategies(df) -> dict[str, int]:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    names = re.findall(r"\n\(\d+\) (SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|Exchange|"
                       r"BroadcastExchange|HashAggregate|SortAggregate|Window)", text)
    return {n: names.count(n) for n in sorted(set(names))}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    ks = [int(a) for a in args[1:]] or [1, 3, 10]
    spark = local_session(shuffle_partitions=32)
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    base = Target.parquet(f"{work}/base", versioned=False)
    write_table(raw_order_lines(spark, sf_dir), base, "raw")
    raw = read_table(spark, base, "raw", schema=RAW.schema)
    out = {}
    for k in ks:
        stage = Target.parquet(f"{work}/x{k}", versioned=False)
        write_table(replicated(raw, k), stage, "raw", max_records_per_file=50_000)
        core_t = Target.parquet(f"{work}/core{k}")
        t = time.perf_counter()
        etl = pipeline.run_etl(spark, stage, core_t)
        times = {"lines": etl.rows["order_items"], "etl": time.perf_counter() - t}
        core = {n: read_table(spark, core_t, n, schema=CORE[n].schema) for n in CORE}
        built = pipeline.marts(core)
        for name in ("dm_orders", "dm_items"):
            t = time.perf_counter()
            write_table(built[name], Target.parquet(f"{work}/dm{k}"), name)
            times[name] = time.perf_counter() - t
        out[k] = {n: (round(v, 2) if isinstance(v, float) else v) for n, v in times.items()}
        if os.environ.get("PLANS") == "1" and k == ks[-1]:
            out["plans_at_%d" % k] = {n: strategies(built[n]) for n in built}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
