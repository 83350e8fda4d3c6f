"""Exact rounding, surrogate keys, quality checks, I/O and the two jobs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopmart.contracts import CORE, DM_ORDERS, ORDERS, conform
from shopmart.functions.money import round_ratio
from shopmart.operators import quality
from shopmart.operators.cleaning import dedupe_by_key, with_surrogate_key
from shopmart.plans import pipeline
from shopmart.sources.fixture import raw_order_lines
from shopmart.sources.io import Target, read_table, write_table
from tests.conftest import SF_SMALL


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**6)),
                min_size=1, max_size=40))
def test_round_ratio_is_exact(spark, pairs):
    df = spark.createDataFrame([(Decimal(n).scaleb(-6), d) for n, d in pairs],
                               "n decimal(28,6), d bigint")
    got = [r[0] for r in df.select(round_ratio("n", 6, "d", 2)).collect()]
    for (n, d), g in zip(pairs, got):
        q = Decimal(n).scaleb(-6) / Decimal(d)
        exact = (abs(Decimal(n)) * 10**8 * 2 + d * 10**6 * 10**6) // (2 * d * 10**6 * 10**6)
        want = (exact if n >= 0 else -exact) / Decimal(100)
        assert g == want, (n, d, q)
        assert g == q.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) or abs(g - q) <= 0.005


def test_surrogate_key_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("a"),
                                     (F.col("id") % 3).alias("b")).repartition(13)
    out = with_surrogate_key(df, "sk", ["a", "b"]).orderBy("sk").collect()
    assert [r.sk for r in out] == list(range(1, 5001))
    assert [(r.a, r.b) for r in out] == sorted((r.a, r.b) for r in out)


def test_dedupe_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0)],
                               "k int, s string, v int")
    got = {r.k: (r.s, r.v) for r in dedupe_by_key(df.repartition(3), ["k"]).collect()}
    assert got == {1: ("b", 2), 2: ("z", 0)}


def test_quality_checks_on_clean_and_broken(spark):
    clean = spark.createDataFrame([(1, 10, 1), (2, 11, 1)], "order_id bigint, user_id bigint, x int")
    broken = clean.unionByName(spark.createDataFrame(
        [(2, None, 1), (None, 12, 1)], "order_id bigint, user_id bigint, x int"))
    orders = conform(clean, ORDERS)
    assert quality.check_unique(orders, ["order_id"]).count() == 0
    assert quality.check_unique(conform(broken, ORDERS), ["order_id"]).count() == 2
    nn = {r.column_name: r.null_rows
          for r in quality.check_not_null(conform(broken, ORDERS), ORDERS).collect()}
    assert nn == {"order_id": 1, "user_id": 1}
    parents = spark.createDataFrame([(10,)], "user_id bigint")
    orphans = quality.check_foreign_key(conform(broken, ORDERS), "user_id", parents, "user_id")
    assert sorted(r.user_id for r in orphans.collect()) == [11, 12]
    bad = conform(spark.createDataFrame(
        [(1, 1, "150.00", "-1.00"), (2, 1, None, None), (3, 1, "5.00", "3.00")],
        "order_id bigint, user_id bigint, order_discount string, delivery_cost string"), ORDERS)
    got = sorted((r.check_name, r.order_id) for r in quality.check_rules(bad, "orders").collect())
    assert got == [("chk_orders_delivery_cost_nonnegative", 1), ("chk_orders_discount_range", 1)]


def test_conform_defaults_and_audit(spark):
    df = spark.createDataFrame([(None, "x")], "gross_amount double, city string")
    out = conform(df, DM_ORDERS, audit=True)
    assert out.columns == DM_ORDERS.names + ["created_at"]
    r = out.first()
    # a default fills an absent column; an explicit NULL stays and is reported
    assert r.gross_amount is None and r.orders_created_cnt == 0 and r.store_id is None
    nulls = {n.column_name: n.null_rows for n in quality.check_not_null(out, DM_ORDERS).collect()}
    assert nulls["gross_amount"] == 1 and nulls["orders_created_cnt"] == 0


def test_versioned_parquet_roundtrip(spark, tmp_path):
    t = Target.parquet(str(tmp_path / "core"))
    df = spark.range(10).withColumnRenamed("id", "user_id").withColumn("user_phone", F.lit("p"))
    write_table(df, t, "users")
    write_table(df.limit(3), t, "users")
    assert read_table(spark, t, "users", schema=CORE["users"].schema).count() == 3


def test_jdbc_roundtrip_in_memory_derby(spark):
    url = "jdbc:derby:memory:shopmart;create=true"
    t = Target.jdbc(url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    df = spark.range(100).select(F.col("id").alias("user_id"),
                                 F.concat(F.lit("p"), F.col("id").cast("string")).alias("user_phone"))
    write_table(df, t, "USERS")
    write_table(df.filter("user_id < 40"), t, "USERS")       # overwrite keeps the table
    back = read_table(spark, t, "USERS", partition_column="USER_ID", lower_bound=0,
                      upper_bound=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 40


def test_run_etl_and_marts_end_to_end(spark, tmp_path):
    raw = raw_order_lines(spark, SF_SMALL)
    stage = Target.parquet(str(tmp_path / "stage"), versioned=False)
    write_table(raw, stage, "raw")
    core, dm = Target.parquet(str(tmp_path / "core")), Target.parquet(str(tmp_path / "dm"))
    etl = pipeline.run_etl(spark, stage, core)
    assert etl.rows == {"users": 150, "stores": 25, "drivers": 10, "items": 196,
                        "orders": 1484, "order_items": 6000, "order_drivers": 4356}
    counts = {k: v.count() for k, v in etl.violations.items()}
    assert counts["fk_order_items_order"] == 67 and counts["fk_order_items_item"] == 105
    assert counts["fk_order_items_replaced_item"] == 9 and counts["fk_order_drivers_order"] == 50
    assert counts["checks_order_items"] == 288 + 26 and counts["checks_orders"] == 14 + 16
    assert counts["unique_order_items"] == 0 and counts["unique_order_drivers_order_id_driver_id"] == 0
    marts = pipeline.run_marts(spark, core, dm)
    assert marts.rows == {"dm_orders": 1437, "dm_items": 5706}
    sk = read_table(spark, core, "order_items").agg(F.min("order_item_sk"), F.max("order_item_sk"),
                                                     F.countDistinct("order_item_sk")).first()
    assert tuple(sk) == (1, 6000, 6000)


def test_run_etl_into_jdbc_parents_first(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_order_lines(spark, SF_SMALL).write.parquet(str(raw_dir))
    stage = Target.parquet(str(tmp_path / "stage"), versioned=False)
    ext = pipeline.run_extract(spark, f"{raw_dir}/*.parquet", stage)
    assert ext.rows == {"raw": 6027}
    db = Target.jdbc("jdbc:derby:memory:core_etl;create=true",
                     driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    first = pipeline.run_etl(spark, stage, db)
    again = pipeline.run_etl(spark, stage, db)          # full refresh, not doubled
    assert first.rows == again.rows
    assert read_table(spark, db, "orders").count() == 1484
    assert read_table(spark, db, "order_items").count() == 6000
    copy = Target.jdbc("jdbc:derby:memory:core_copy;create=true",
                       driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert pipeline.run_load(spark, db, copy).rows == first.rows
    assert pipeline.run_load(spark, db, copy).rows == first.rows   # reload, not doubled
    assert read_table(spark, copy, "order_drivers").count() == 4356
    core = pipeline.read_core(spark, db, jdbc_partitions=4)
    assert core["order_items"].rdd.getNumPartitions() == 4
    dm = Target.parquet(str(tmp_path / "dm"))
    assert pipeline.run_marts(spark, db, dm, jdbc_partitions=4).rows == \
        {"dm_orders": 1437, "dm_items": 5706}


def test_jdbc_target_from_env():
    from shopmart.sources.io import jdbc_target_from_env
    t = jdbc_target_from_env({"POSTGRES_HOST": "db", "POSTGRES_DB": "shop", "POSTGRES_USER": "u"})
    assert t.location == "jdbc:postgresql://db:5432/shop"
    assert t.options["user"] == "u" and t.options["driver"] == "org.postgresql.Driver"


def test_fail_on_violation_and_catalog_target(spark, tmp_path):
    import pytest as _pytest
    stage = Target.parquet(str(tmp_path / "stage"), versioned=False)
    write_table(raw_order_lines(spark, SF_SMALL), stage, "raw")
    with _pytest.raises(pipeline.ConstraintViolation) as err:
        pipeline.run_etl(spark, stage, Target.parquet(str(tmp_path / "core")),
                         fail_on_violation=True)
    assert err.value.counts["fk_order_items_order"] == 67
    assert "unique_orders" not in err.value.counts
    pipeline.run_etl(spark, stage, Target.parquet(str(tmp_path / "core")))
    spark.sql("CREATE DATABASE IF NOT EXISTS shopmart_test")
    cat = Target.table("shopmart_test")
    write_table(read_table(spark, Target.parquet(str(tmp_path / "core")), "users"), cat, "users")
    assert read_table(spark, cat, "users").count() == 150


def test_check_predicate_single_rule(spark):
    df = spark.createDataFrame([(1, 5, 3), (2, 2, 4), (3, None, 1)],
                               "order_id bigint, item_quantity int, item_canceled_quantity int")
    bad = quality.check_predicate(df, "lte", F.col("item_canceled_quantity") <= F.col("item_quantity"))
    assert [(r.check_name, r.order_id) for r in bad.collect()] == [("lte", 2)]   # NULL passes


def test_surrogate_key_splits_hot_values(spark):
    """Copies are numbered as one row; a hot first value is spread over cells of the second."""
    copies = spark.range(0, 30000).select(F.lit(7).alias("a"), F.lit(1).alias("b"))
    hot = spark.range(0, 20000).select(F.lit(9).alias("a"), F.col("id").cast("int").alias("b"))
    df = copies.unionByName(hot).repartition(6)
    out = with_surrogate_key(df, "sk", ["a", "b"])
    rows = [(r.sk, r.a, r.b) for r in out.collect()]
    assert sorted(r[0] for r in rows) == list(range(1, 50001))
    assert [r[1:] for r in sorted(rows)] == sorted(r[1:] for r in rows)
    small = with_surrogate_key(df, "sk", ["a", "b"], cell_rows=500)      # the hot value has several cells
    assert sorted((r.sk, r.a, r.b) for r in small.collect()) == sorted(rows)


def test_surrogate_key_nulls_first_and_text(spark):
    df = spark.createDataFrame([("b", 1), (None, 5), ("a", None), ("a", 2), (None, None), ("a", 2)],
                               "a string, b int")
    rows = sorted((r.sk, r.a, r.b) for r in with_surrogate_key(df, "sk", ["a", "b"]).collect())
    assert rows == [(1, None, None), (2, None, 5), (3, "a", None), (4, "a", 2), (5, "a", 2),
                    (6, "b", 1)]


def test_building_and_loading_leave_no_copies(spark, tmp_path):
    import os

    from shopmart.plans import catalog
    folder = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(folder))
    catalog.run(spark, SF_SMALL, "check_not_null_core")
    pipeline.run_etl(spark, raw_order_lines(spark, SF_SMALL), Target.parquet(str(tmp_path / "core")))
    assert set(os.listdir(folder)) == before


def test_a_table_without_a_finished_version_is_an_error(spark, tmp_path):
    import shutil

    import pytest as _pytest
    t = Target.parquet(str(tmp_path / "core"))
    df = spark.range(10).withColumnRenamed("id", "user_id").withColumn("user_phone", F.lit("p"))
    write_table(df, t, "users")
    write_table(df.limit(3), t, "users")
    # a version whose writer died before it was listed
    df.unionByName(df).write.parquet(f"{tmp_path}/core/users/version=9{'0' * 18}")
    assert read_table(spark, t, "users").count() == 3
    with _pytest.raises(FileNotFoundError):
        read_table(spark, t, "stores")
    shutil.rmtree(tmp_path / "core" / "_snapshots")
    with _pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, t, "users")


def test_schema_drift_raises_before_anything_is_written(spark, tmp_path):
    import pytest as _pytest

    from shopmart.sources.io import SchemaDrift
    raw = raw_order_lines(spark, SF_SMALL).limit(20)
    drifted = {"missing": raw.drop("item_price"),
               "renamed": raw.withColumnRenamed("item_id", "itemid"),
               "retyped": raw.withColumn("item_quantity", F.col("item_quantity").cast("string"))}
    for name, df in drifted.items():
        stage = Target.parquet(str(tmp_path / name))
        write_table(df, stage, "raw")
        core = tmp_path / f"{name}_core"
        with _pytest.raises(SchemaDrift, match="item_"):
            pipeline.run_etl(spark, stage, Target.parquet(str(core)))
        files = read_table(spark, stage, "raw").inputFiles()[0].rsplit("/", 1)[0]
        with _pytest.raises(SchemaDrift):
            pipeline.run_extract(spark, f"{files}/*.parquet", Target.parquet(str(core)))
        assert not core.exists()


def test_partitioned_write_has_few_files(spark, tmp_path):
    import glob
    df = spark.range(20000).select((F.col("id") % 12).alias("m"), F.col("id")).repartition(16)
    path = write_table(df, Target.parquet(str(tmp_path / "t")), "x", partition_by=["m"])
    files = glob.glob(f"{path}/m=*/part-*.parquet")
    assert 12 <= len(files) <= 24


def test_jdbc_options_and_sql():
    from shopmart.sources.io import bounds_query, jdbc_target_from_env
    t = jdbc_target_from_env({}, schema="core")
    assert t.options["cascadeTruncate"] == "true" and int(t.options["fetchsize"]) > 0
    assert t.dbtable("orders") == "core.orders"
    assert bounds_query(t, "orders", "order_id") == \
        "(SELECT MIN(order_id) AS lo, MAX(order_id) AS hi FROM core.orders) b"
    own = Target.jdbc("jdbc:derby:memory:x", fetchsize="5")
    assert own.options["fetchsize"] == "5" and own.dbtable("T") == "T"
    assert "cascadeTruncate" not in own.options
    from shopmart.cli import target
    assert target("jdbc:postgresql://db/shop", "dm").dbtable("dm_orders") == "dm.dm_orders"


def test_jdbc_schema_and_bounds_in_memory_derby(spark):
    url = "jdbc:derby:memory:shopschema;create=true"
    t = Target.jdbc(url, schema="CORE", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    write_table(spark.range(5, 105).withColumnRenamed("id", "USER_ID"), t, "USERS")
    back = read_table(spark, t, "USERS", partition_column="USER_ID", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 100


def test_present_maps_to_engine_neutral_types(spark):
    from datetime import date
    from shopmart.contracts import present
    df = spark.createDataFrame([(date(2024, 1, 2), 3, Decimal("1.25"), True, "x")],
                               "d date, i int, m decimal(18,2), b boolean, s string")
    out = present(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == \
        ["timestamp_ntz", "bigint", "double", "bigint", "string"]
    r = out.first()
    assert (r.d.isoformat(), r.i, r.m, r.b, r.s) == ("2024-01-02T00:00:00", 3, 1.25, 1, "x")


def test_surrogate_key_is_reproducible(spark):
    df = spark.range(0, 20000).select((F.col("id") * 37 % 20000).alias("a")).repartition(7)
    first = {r.a: r.sk for r in with_surrogate_key(df, "sk", ["a"]).collect()}
    second = {r.a: r.sk for r in with_surrogate_key(df.repartition(3), "sk", ["a"]).collect()}
    assert first == second and sorted(first.values()) == list(range(1, 20001))
