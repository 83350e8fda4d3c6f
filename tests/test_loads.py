"""Loads that are visible all at once, schemas of every file, JDBC transactions, SQL over the marts."""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopmart import cli
from shopmart.contracts import CORE, DM_ITEMS, DM_ORDERS, RAW, conform
from shopmart.operators import normalize, reports
from shopmart.plans import pipeline
from shopmart.sources import io, load
from shopmart.sources.fixture import raw_order_lines
from shopmart.sources.io import SchemaDrift, Target, footers, read_table, snapshot, write_table
from shopmart.sources.load import ATTEMPT, PART, Database, Load, clean, refresh_views

SF_SMALL = "/root/testdata/sf0.001"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
ROOT = Path(__file__).resolve().parents[1]


def derby(name, schema=None):
    return Target.jdbc(f"jdbc:derby:memory:{name};create=true", schema=schema, driver=DRIVER)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw lines, staged as several files."""
    stage = Target.parquet(str(tmp_path_factory.mktemp("raw")), versioned=False)
    write_table(raw_order_lines(spark, SF_SMALL), stage, "raw", max_records_per_file=1000)
    return stage


def counts(spark, core):
    return {n: df.count() for n, df in pipeline.read_core(spark, core).items()}


@pytest.mark.parametrize("how", ["rejected", "killed"])
def test_a_load_that_fails_leaves_the_last_whole_snapshot(spark, tmp_path, raw, monkeypatch, how):
    core = Target.parquet(str(tmp_path / "core"))
    half = read_table(spark, raw, "raw").where("order_id % 2 = 0")
    pipeline.run_etl(spark, half, core)
    before, listed = counts(spark, core), snapshot(spark, core)
    if how == "killed":
        whole_write = Load.write

        def dies(self, df, name, **kw):
            if name == "orders":
                raise RuntimeError("lost")
            return whole_write(self, df, name, **kw)
        monkeypatch.setattr(Load, "write", dies)
    with pytest.raises(pipeline.ConstraintViolation if how == "rejected" else RuntimeError):
        pipeline.run_etl(spark, raw, core, fail_on_violation=True)
    monkeypatch.undo()
    assert snapshot(spark, core) == listed and counts(spark, core) == before
    pipeline.run_etl(spark, raw, core)
    after = snapshot(spark, core)
    assert all(after[n] != listed[n] for n in CORE) and counts(spark, core)["orders"] == 1484


def test_tables_of_one_read_are_of_one_snapshot(spark, tmp_path, raw):
    core = Target.parquet(str(tmp_path / "core"))
    half = read_table(spark, raw, "raw").where("order_id % 2 = 0")
    pipeline.run_etl(spark, half, core)
    frames = pipeline.read_core(spark, core)     # taken before the next load is published
    n = frames["orders"].count()
    pipeline.run_etl(spark, raw, core)
    assert frames["orders"].count() == n < counts(spark, core)["orders"]


def test_clean_removes_what_no_snapshot_lists(spark, tmp_path):
    t = Target.parquet(str(tmp_path / "t"))
    rows = spark.range(10).withColumnRenamed("id", "user_id")
    for _ in range(3):
        write_table(rows, t, "users")
    write_table(rows, t, "stores")
    lost = Load(spark, t)
    lost.write(rows, "users")                    # never published
    assert clean(spark, t, keep=2) == []         # all younger than the grace time
    removed = clean(spark, t, keep=2, grace_hours=0)
    assert sorted(r.split("/")[0] for r in removed) == ["_snapshots", "users", "users"]
    assert read_table(spark, t, "users").count() == read_table(spark, t, "stores").count() == 10
    assert clean(spark, t, keep=1, grace_hours=0) and read_table(spark, t, "users").count() == 10


DRIFT = {"missing": lambda df: df.drop("item_price"),
         "renamed": lambda df: df.withColumnRenamed("item_id", "itemid"),
         "retyped": lambda df: df.withColumn("item_quantity", F.col("item_quantity").cast("bigint")),
         "rescaled": lambda df: df.withColumn("item_price", F.col("item_price").cast("decimal(14,2)"))}


@pytest.mark.parametrize("kind, place, bytes_only", [
    *((kind, place, False) for kind in DRIFT for place in ("0first", "z_last")),
    ("missing", "z_last", True), ("retyped", "0first", True)])
def test_one_drifted_file_among_many_raises(spark, tmp_path, raw, monkeypatch, kind, place, bytes_only):
    if bytes_only:   # a store that tasks cannot open: Spark hands over the bytes
        monkeypatch.setattr(io, "_task_can_open", lambda path: False)
    folder = tmp_path / "stage" / "raw"
    lines = read_table(spark, raw, "raw")
    lines.repartition(4).write.parquet(str(folder))
    good = next(folder.glob("*.parquet"))
    DRIFT[kind](lines.limit(5)).coalesce(1).write.parquet(str(tmp_path / "bad"))
    next((tmp_path / "bad").glob("*.parquet")).rename(folder / f"{place}.parquet")
    core = tmp_path / "core"
    with pytest.raises(SchemaDrift, match=f"item_.*1 files.*{place}"):
        pipeline.run_etl(spark, Target.parquet(str(tmp_path / "stage"), versioned=False),
                         Target.parquet(str(core)))
    with pytest.raises(SchemaDrift):
        pipeline.run_extract(spark, f"{folder}/*.parquet", Target.parquet(str(core)))
    assert not core.exists()
    io.check_schema(spark, str(good), RAW.schema)
    io.check_schema(spark, f"{folder}/part-*.parquet", RAW.schema)


def test_footers_have_a_row_per_file_and_column(spark, tmp_path):
    for part in "ab":
        spark.range(3).selectExpr("id", "cast(id as string) s", "named_struct('x', id, 'y', 1) n").coalesce(
            1).write.parquet(f"{tmp_path}/t/p={part}")
    rows = footers(spark, f"{tmp_path}/t").collect()
    assert len(rows) == 6 and {r["column"] for r in rows} == {"id", "s", "n"}
    io.check_schema(spark, f"{tmp_path}/t", spark.read.parquet(f"{tmp_path}/t").drop("p").schema)


def test_rows_staged_twice_by_a_repeated_task_count_once(spark):
    db = derby("retried")
    staged = Load(spark, db)
    df = spark.range(0, 1000, 1, 4).selectExpr("id as user_id", "cast(id as string) user_phone")
    staged.write(df, "users")
    stage = db.dbtable(staged.staged["users"])
    with Database(spark, db) as connection:    # partition 2 committed, was lost and repeated; 3 is half there
        q = connection.dialect.quoteIdentifier
        cols = f"{q('user_id')}, {q('user_phone')}, {q(PART)}"
        for part, more in ((2, ""), (3, f" AND {q('user_id')} < 800")):
            assert connection.run(f"INSERT INTO {stage} ({cols}, {q(ATTEMPT)}) SELECT {cols}, 99999 "
                                  f"FROM {stage} WHERE {q(PART)} = {part}{more}") in (250, 50)
        connection.commit()
    assert staged.rows("users") == 1000
    staged.publish()
    back = read_table(spark, db, "users")
    assert back.count() == 1000 == back.select("user_id").distinct().count()
    assert set(back.columns) == {"user_id", "user_phone"}


def test_a_real_task_that_fails_after_its_insert_is_counted_once(tmp_path):
    """local[2, 4] repeats failed tasks; the first attempt of a partition fails when its rows are in."""
    code = f"""
    import sys; sys.path.insert(0, {str(ROOT)!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from shopmart.session import local_session
    from shopmart.sources import load
    from shopmart.sources.io import Target, jdbc_writer, read_table
    spark = local_session("local[2,4]", app_name="retry")
    db = Target.jdbc("jdbc:derby:memory:retry;create=true", driver={DRIVER!r})
    staged = load.Load(spark, db)
    df = spark.range(0, 400, 1, 4).withColumnRenamed("id", "user_id")
    staged.write(df.limit(0), "users")
    stage = staged.staged["users"]
    def insert_then_fail(batches):          # commits by itself, as a task whose executor is lost afterwards
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
            raise RuntimeError("lost after the insert")
    stamped = load.with_attempt(df)
    jdbc_writer(stamped.where("load_part = 1").withColumn("load_attempt", F.lit(777)), db, stage, "append").save()
    jdbc_writer(stamped.mapInArrow(insert_then_fail, stamped.schema), db, stage, "append").save()
    assert staged.rows("users") == 400, staged.rows("users")
    staged.publish()
    assert read_table(spark, db, "users").distinct().count() == read_table(spark, db, "users").count() == 400
    print("whole")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True,
                          cwd=tmp_path, timeout=300)
    assert "whole" in done.stdout, done.stderr[-3000:]


def test_a_failed_jdbc_load_leaves_the_old_rows(spark):
    db = derby("refused")
    with Database(spark, db) as connection:
        connection.run('CREATE TABLE "users" ("user_id" BIGINT PRIMARY KEY, "user_phone" VARCHAR(20))')
        connection.run('CREATE TABLE "orders" ("order_id" BIGINT PRIMARY KEY, "user_id" BIGINT '
                       'REFERENCES "users" ("user_id"))')
        connection.commit()
    quoted = Target.jdbc(db.location, driver=DRIVER)
    users = spark.range(5).selectExpr("id as user_id", "'p' as user_phone")
    orders = spark.range(20).selectExpr("id as order_id", "id % 5 as user_id")

    def reload(users, orders):
        staged = Load(spark, quoted)
        staged.write(users, '"users"')
        staged.write(orders, '"orders"')
        staged.publish(['"users"', '"orders"'])
    # quoted names keep Derby's case; the staging table's name is quoted as a whole
    Load._stage_name, plain = (lambda self, name: f'"{name.strip(chr(34))}_load_{self.run}"'), Load._stage_name
    try:
        reload(users, orders)
        assert read_table(spark, quoted, '"orders"').count() == 20
        with pytest.raises(Exception, match="(?i)foreign key"):
            reload(users.where("user_id < 3"), orders)       # orders of unknown users
        with pytest.raises(Exception, match="(?i)duplicate"):
            reload(users.unionAll(users), orders)
        assert read_table(spark, quoted, '"orders"').count() == 20
        assert read_table(spark, quoted, '"users"').count() == 5
        with Database(spark, quoted) as connection:
            left = connection.rows("SELECT COUNT(*) FROM SYS.SYSTABLES WHERE TABLENAME LIKE '%_load_%'")
        assert left == [(0,)] or int(left[0][0]) == 0
        reload(users, orders.where("order_id < 7"))
        assert read_table(spark, quoted, '"orders"').count() == 7
    finally:
        Load._stage_name = plain


def test_rejected_jdbc_etl_leaves_the_old_tables(spark, raw):
    db = derby("core_checked")
    half = read_table(spark, raw, "raw").where("order_id % 2 = 0")
    first = pipeline.run_etl(spark, half, db)
    with pytest.raises(pipeline.ConstraintViolation):
        pipeline.run_etl(spark, raw, db, fail_on_violation=True)
    assert read_table(spark, db, "orders").count() == first.rows["orders"]
    assert first.violations["fk_order_items_order"].count() > 0    # over the published tables


def test_row_counts_are_those_of_the_committed_files(spark, tmp_path, raw):
    core, dm = Target.parquet(str(tmp_path / "core")), Target.parquet(str(tmp_path / "dm"))
    done = pipeline.run_etl(spark, raw, core)
    assert done.rows == counts(spark, core)
    marts = pipeline.run_marts(spark, core, dm, partition_by=["report_year", "report_month"])
    assert marts.rows == {n: read_table(spark, dm, n).count() for n in ("dm_orders", "dm_items")}


def test_catalog_target_is_switched_by_name(spark, raw):
    spark.sql("CREATE DATABASE IF NOT EXISTS shopmart_switch")
    target = Target.table("shopmart_switch")
    half = read_table(spark, raw, "raw").where("order_id % 2 = 0")
    first = pipeline.run_etl(spark, half, target)
    with pytest.raises(pipeline.ConstraintViolation):
        pipeline.run_etl(spark, raw, target, fail_on_violation=True)
    assert counts(spark, target) == first.rows
    again = pipeline.run_etl(spark, raw, target)
    assert counts(spark, target) == again.rows != first.rows
    assert {t.name for t in spark.catalog.listTables("shopmart_switch") if not t.isTemporary} == set(CORE)


# The eight reports as SQL text over the marts.
MEAN = "round(avg({}), 2)"
RATE = "round(100.0 * {} / nullif({}, 0), 2)"
STORE, ITEM = "city, store_id, store_address", "item_id, item_title, item_category"
STATEMENTS = {
    "q1_weekday_totals": """SELECT dayofweek(report_date) - 1 AS day_of_week_num,
      date_format(report_date, 'EEEE') AS day_of_week, sum(gross_amount) AS total_gross,
      sum(revenue_amount) AS total_revenue, sum(profit_amount) AS total_profit
      FROM dm_orders GROUP BY 1, 2 ORDER BY 1""",
    "q2_monthly_buyers": f"""SELECT report_year, report_month, {MEAN.format('avg_check_amount')} AS avg_check,
      {MEAN.format('orders_per_buyer')} AS avg_orders_per_buyer,
      {MEAN.format('revenue_per_buyer')} AS avg_revenue_per_buyer
      FROM dm_orders GROUP BY report_year, report_month ORDER BY 1, 2""",
    "q3_best_check_stores": f"""SELECT {STORE}, {MEAN.format('avg_check_amount')} AS avg_check FROM dm_orders
      GROUP BY {STORE} ORDER BY avg_check DESC, {STORE} LIMIT 10""",
    "q4_driver_change_rate": f"""SELECT {STORE}, sum(orders_created_cnt) AS total_orders,
      sum(orders_with_driver_change_cnt) AS driver_changed_orders,
      {RATE.format('sum(orders_with_driver_change_cnt)', 'sum(orders_created_cnt)')} AS driver_change_rate_pct
      FROM dm_orders GROUP BY {STORE} HAVING total_orders > 0
      ORDER BY driver_change_rate_pct DESC, driver_changed_orders DESC, {STORE} LIMIT 10""",
    "q5_category_turnover": """SELECT item_category, sum(item_gross_amount) AS total_gross FROM dm_items
      GROUP BY item_category ORDER BY total_gross DESC, 1""",
    "q6_most_canceled_items": f"""SELECT {ITEM}, sum(canceled_quantity) AS total_canceled_quantity
      FROM dm_items GROUP BY {ITEM} ORDER BY 4 DESC, {ITEM} LIMIT 10""",
    "q7_item_cancel_rate": f"""SELECT {ITEM}, sum(ordered_quantity) AS total_ordered,
      sum(canceled_quantity) AS total_canceled,
      {RATE.format('sum(canceled_quantity)', 'sum(ordered_quantity)')} AS cancel_rate_pct
      FROM dm_items GROUP BY {ITEM} HAVING total_ordered >= 100
      ORDER BY cancel_rate_pct DESC, total_canceled DESC, {ITEM} LIMIT 10""",
    "q8_item_order_cancel_rate": f"""SELECT {ITEM}, sum(orders_with_item_cnt) AS total_orders_with_item,
      sum(orders_with_item_cancellation_cnt) AS canceled_orders_with_item,
      {RATE.format('sum(orders_with_item_cancellation_cnt)', 'sum(orders_with_item_cnt)')}
        AS cancellation_rate_pct
      FROM dm_items GROUP BY {ITEM} HAVING total_orders_with_item >= 50
      ORDER BY cancellation_rate_pct DESC, {ITEM} LIMIT 10""",
}


def plain(df):
    return [tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.collect()]


def test_report_statements_run_as_sql_over_views_of_the_newest_snapshot(spark, tmp_path, raw, capsys):
    core, dm = Target.parquet(str(tmp_path / "core")), Target.parquet(str(tmp_path / "dm"))
    pipeline.run_etl(spark, raw, core)
    spark.sql("CREATE DATABASE IF NOT EXISTS shopmart_dm")
    pipeline.run_marts(spark, core, dm, views="shopmart_dm")
    marts = {"dm_orders": read_table(spark, dm, "dm_orders", schema=DM_ORDERS.schema),
             "dm_items": read_table(spark, dm, "dm_items", schema=DM_ITEMS.schema)}
    refresh_views(spark, dm, {"dm_orders": DM_ORDERS.schema, "dm_items": DM_ITEMS.schema})
    spark.sql("USE shopmart_dm")
    try:
        for name, (mart, fn) in reports.REPORTS.items():
            want = fn(marts[mart])
            got = spark.sql(STATEMENTS[name])
            assert got.columns == want.columns
            assert plain(got) == plain(want), name
        assert spark.table("shopmart_dm.dm_orders").schema.simpleString() == \
            marts["dm_orders"].schema.simpleString()
        pipeline.run_etl(spark, read_table(spark, raw, "raw").where("order_id % 2 = 0"), core)
        old = spark.table("shopmart_dm.dm_items").count()
        newer = pipeline.run_marts(spark, core, dm, views="shopmart_dm")
        assert spark.table("shopmart_dm.dm_items").count() == newer.rows["dm_items"] < old
    finally:
        spark.sql("USE default")
    assert cli.main(["sql", "SELECT count(*) AS n FROM dm_items JOIN stores USING (store_id)",
                     "--dm", dm.location, "--core", core.location]) == 0
    assert json.loads(capsys.readouterr().out)["n"] == newer.rows["dm_items"]


def test_command_line_options(spark, tmp_path, raw, capsys):
    core = str(tmp_path / "core")
    staged = str(tmp_path / "stage")
    cli.main(["extract", "--raw", f"{raw.location}/raw/*.parquet", "--stage", staged])
    capsys.readouterr()
    assert cli.main(["etl", "--stage", staged, "--core", core, "--fail-on-violation"]) == 1
    assert json.loads(capsys.readouterr().out)["violations"]["fk_order_items_order"] == 67
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pipeline.read_core(spark, Target.parquet(core))
    assert cli.main(["etl", "--stage", staged, "--core", core]) == 0
    dms = [str(tmp_path / d) for d in ("a", "b")]
    cli.main(["marts", "--core", core, "--dm", dms[0]])
    cli.main(["marts", "--core", core, "--dm", dms[1], "--method", "windows"])
    one, two = (read_table(spark, Target.parquet(d), "dm_items").drop("load_dttm") for d in dms)
    cols = DM_ITEMS.names
    assert one.select(*cols).exceptAll(two.select(*cols)).count() == 0
    cli.main(["marts", "--core", core, "--dm", str(tmp_path / "iso"), "--iso-year"])
    capsys.readouterr()
    assert cli.main(["clean", core, "--grace-hours", "0"]) == 0
    assert len(json.loads(capsys.readouterr().out)["removed"]) == 7     # the rejected load's folders


@pytest.mark.parametrize("package", ["xxhash", "ahocorasick", "tiktoken", "corpus_pipeline", "shopmart.llm"])
def test_entry_point_without_an_optional_package(package):
    named = package if (ROOT / "corpus_pipeline.py").exists() else "left out"
    code = f"""
    import sys, warnings; sys.path.insert(0, {str(ROOT)!r}); sys.modules[{package!r}] = None
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        import __spark_entry__ as entry
    assert len([q for q in entry.queries() if not q.startswith("op") and q != "pipeline"]) == 61
    assert any("left out" in str(w.message) and {named!r} in str(w.message) for w in told)
    print("fine")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True)
    assert "fine" in done.stdout, done.stderr[-2000:]


def broken_core(spark):
    """Core tables with every kind of violation."""
    tables = {n: spark.createDataFrame([], c.schema) for n, c in CORE.items()}
    rows = {"users": [(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)],
            "stores": [(5, None, None)], "drivers": [(7, "x")],
            "items": [(10, "t", None), (11, None, None)],
            "order_drivers": [(1, 100, 7), (2, 100, 7), (3, None, 7), (4, None, 7), (5, 101, 8), (5, 102, None)]}
    for name, values in rows.items():
        tables[name] = spark.createDataFrame(values, CORE[name].schema)
    tables["orders"] = conform(spark.sql(
        "SELECT * FROM VALUES (100L, 1L, 5L, NULL, NULL), (101L, 3L, 6L, 101, -1), (101L, NULL, NULL, -1, 1) "
        "AS t(order_id, user_id, store_id, order_discount, delivery_cost)"), CORE["orders"])
    tables["order_items"] = conform(spark.sql(
        "SELECT * FROM VALUES (1L, 100L, 10L, 1, 1, 2, 0, 12L), (2L, 9L, 13L, -1, -1, -1, 101, NULL), "
        "(2L, NULL, NULL, NULL, NULL, 0, 0, 10L) AS t(order_item_sk, order_id, item_id, item_quantity, item_price, "
        "item_canceled_quantity, item_discount, item_replaced_id)"), CORE["order_items"])
    return tables


def single_checks(tables):
    out = {}
    for name, df in pipeline.core_violations(tables).items():
        out[name] = int(df.agg(F.sum("null_rows")).first()[0] or 0) if name.startswith("not_null_") else df.count()
    return out


def test_one_pass_counts_equal_the_single_checks(spark, tmp_path, raw):
    tables = broken_core(spark)
    want = single_checks(tables)
    got = {r.check_name: r.violations for r in pipeline.count_core_violations(tables).collect()}
    assert got == want and all(want[k] for k in want if not k.startswith(("unique_stores", "unique_drivers",
                               "unique_items", "not_null_stores", "not_null_drivers")))
    core = Target.parquet(str(tmp_path / "core"))
    pipeline.run_etl(spark, raw, core)
    tables = pipeline.read_core(spark, core)
    assert {r.check_name: r.violations for r in pipeline.count_core_violations(tables).collect()} == \
        single_checks(tables)
    empty = {n: df.limit(0) for n, df in tables.items()}
    assert {r.violations for r in pipeline.count_core_violations(empty).collect()} == {0}


def test_one_pass_scans_each_table_once_with_one_exchange(spark, tmp_path, raw):
    core = Target.parquet(str(tmp_path / "core"))
    pipeline.run_etl(spark, raw, core)
    summary = pipeline.count_core_violations(pipeline.read_core(spark, core))
    plan = summary._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == len(CORE)
    executed = summary._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and "Join" not in executed


def test_reports_on_a_jdbc_mart_aggregate_in_the_database(spark, tmp_path, raw):
    core, dm = Target.parquet(str(tmp_path / "core")), Target.parquet(str(tmp_path / "dm"))
    pipeline.run_etl(spark, raw, core)
    pipeline.run_marts(spark, core, dm)
    db = derby("mart_v2")
    marts = {}
    for name, contract in (("dm_orders", DM_ORDERS), ("dm_items", DM_ITEMS)):
        marts[name] = read_table(spark, dm, name, schema=contract.schema).na.fill("none")
        texts = ", ".join(f"{c} VARCHAR(300)" for c, t in contract.columns if t.simpleString() == "string")
        io.jdbc_writer(marts[name], db, name, "error").option("createTableColumnTypes", texts).save()
    pushed = {"q2_monthly_buyers": "SUM(avg_check_amount)", "q3_best_check_stores": "SUM(avg_check_amount)",
              "q4_driver_change_rate": "SUM(orders_created_cnt)", "q5_category_turnover": "SUM(item_gross_amount)",
              "q6_most_canceled_items": "SUM(canceled_quantity)", "q7_item_cancel_rate": "SUM(ordered_quantity)",
              "q8_item_order_cancel_rate": "SUM(orders_with_item_cnt)"}
    for name, (mart, fn) in reports.REPORTS.items():
        got = fn(io.pushed_table(spark, db, mart.upper()))
        assert plain(got) == plain(fn(marts[mart])), name
        if name in pushed:
            scan = got._jdf.queryExecution().executedPlan().toString()
            assert f"PushedAggregates: [{pushed[name]}" in scan and "PushedGroupByExpressions" in scan


@pytest.mark.parametrize("kind", ["parquet", "jdbc"])
def test_sequences_go_on_after_an_append_and_restart_on_reload(spark, tmp_path, raw, kind):
    core = Target.parquet(str(tmp_path / "core")) if kind == "parquet" else derby("appended")
    lines = read_table(spark, raw, "raw").where("order_id < 800")
    first = pipeline.run_etl(spark, lines, core).rows["order_items"]
    more = normalize.CORE_BUILDERS["order_items"](pipeline.fill_defaults(
        read_table(spark, raw, "raw").where("order_id >= 800 and order_id < 1200")))
    for _ in range(2):
        added = pipeline.append_rows(spark, core, "order_items", more).rows["order_items"]
    assert added == more.count() > 0
    keys = sorted(r[0] for r in read_table(spark, core, "order_items").select("order_item_sk").collect())
    assert keys == list(range(1, first + 2 * added + 1))
    late = read_table(spark, core, "order_items").where(f"order_item_sk > {first}")
    assert late.agg(F.min("order_id")).first()[0] >= 800
    pipeline.run_etl(spark, lines, core)
    keys = sorted(r[0] for r in read_table(spark, core, "order_items").select("order_item_sk").collect())
    assert keys == list(range(1, first + 1))
    assert pipeline.append_rows(spark, core, "order_items", more).rows["order_items"] == added
    assert read_table(spark, core, "order_items").agg(F.max("order_item_sk")).first()[0] == first + added
