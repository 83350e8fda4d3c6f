"""Time the jobs on normal data and on data where one key holds a third of the lines.

    python tools/skew_probe.py [sf_dir]

The skewed copy moves every third raw line onto one order (and so one
user, store and day) and one item; the marts must come out with the same
row structure and the jobs should not slow down in proportion.
Prints one JSON line.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, ".")

from shopmart.contracts import CORE, RAW  # noqa: E402
from shopmart.plans import pipeline  # noqa: E402
from shopmart.session import local_session  # noqa: E402
from shopmart.sources.fixture import raw_order_lines  # noqa: E402
from shopmart.sources.io import Target, read_table, write_table  # noqa: E402


def chain(spark, raw_target, work):
    out = {}
    t = time.perf_counter()
    etl = pipeline.run_etl(spark, raw_target, Target.parquet(f"{work}/core"))
    out["etl"] = time.perf_counter() - t
    t = time.perf_counter()
    pipeline.run_concurrently({k: v.count for k, v in etl.violations.items()}, 4)
    out["checks"] = time.perf_counter() - t
    core = {n: read_table(spark, Target.parquet(f"{work}/core"), n, schema=CORE[n].schema)
            for n in CORE}
    m = pipeline.marts(core)
    for name in ("dm_orders", "dm_items"):
        t = time.perf_counter()
        write_table(m[name], Target.parquet(f"{work}/dm"), name)
        out[name] = time.perf_counter() - t
    return {k: round(v, 2) for k, v in out.items()}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(f"{work}/ckpt")
    stage = Target.parquet(f"{work}/stage", versioned=False)
    write_table(raw_order_lines(spark, sf_dir), stage, "raw")
    raw = read_table(spark, stage, "raw", schema=RAW.schema)
    hot = raw.filter("order_id = 1").select("user_id", "store_id", "store_address",
                                            "address_text", "created_at").first()
    third = F.pmod(F.xxhash64("order_id", "item_id", "driver_id", "item_quantity"), 3) == 0
    skewed = raw.withColumns({
        "order_id": F.when(third, F.lit(1)).otherwise(F.col("order_id")),
        "user_id": F.when(third, F.lit(hot.user_id)).otherwise(F.col("user_id")),
        "store_id": F.when(third, F.lit(hot.store_id)).otherwise(F.col("store_id")),
        "store_address": F.when(third, F.lit(hot.store_address)).otherwise(F.col("store_address")),
        "address_text": F.when(third, F.lit(hot.address_text)).otherwise(F.col("address_text")),
        "created_at": F.when(third, F.lit(hot.created_at)).otherwise(F.col("created_at")),
        "item_id": F.when(third, F.lit(7)).otherwise(F.col("item_id")),
    })
    skew_stage = Target.parquet(f"{work}/skew_stage", versioned=False)
    write_table(skewed, skew_stage, "raw")
    chain(spark, stage, f"{work}/warm")                   # JIT warm-up
    normal = chain(spark, stage, f"{work}/normal")
    hot_run = chain(spark, skew_stage, f"{work}/skewed")
    lines_on_hot = read_table(spark, skew_stage, "raw").filter("order_id = 1").count()
    print(json.dumps({"sf_dir": sf_dir, "lines_on_hot_order": lines_on_hot,
                      "normal": normal, "skewed": hot_run}))


if __name__ == "__main__":
    main()
