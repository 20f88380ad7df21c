"""CSV sources/sinks, preparation and label operators on hand-made rows."""

import datetime as dt
import os
import uuid

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.operators import labels, prep
from dayguard.params import Params
from dayguard.sources import csvio

D = dt.date


def _path(spark, name):
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def test_csv_writes_nan_for_null_and_reads_back(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([(1, D(2024, 1, 2), None), (2, D(2024, 1, 3), 1.5)], schema)
    path = csvio.write_csv(df, _path(spark, "csv"), single_file=True)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert "NaN" in text and text.startswith("k,d,x")
    back = csvio.read_csv(spark, path, schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_tsv_reader_tolerates_column_count_mismatch(spark):
    path = _path(spark, "tsv")
    os.makedirs(path)
    with open(os.path.join(path, "ato.tsv"), "w") as f:
        f.write("order_id\tcustomer_id\n7\t70\n14\t140\textra\n21\n")
    rows = sorted(csvio.read_csv(spark, path, csvio.ATO_LABEL_SCHEMA, sep="\t", tolerant=True).collect())
    assert [tuple(r) for r in rows] == [(7, 70), (14, 140), (21, None)]


def _features(spark):
    rows = [(1, D(2024, 1, 10), None, 2.0), (1, D(2024, 1, 11), 3, None),
            (2, D(2024, 1, 10), 5, 1.0), (3, D(2024, 1, 12), 5, 4.0)]
    return spark.createDataFrame(rows, "CUSTOMER_ID long, GA_SESSIONS_DATE date, a long, b double")


def test_fill_and_scaler_constant_column(spark):
    df = prep.fill_nulls(_features(spark), ["a", "b"])
    assert df.where("a IS NULL OR b IS NULL").count() == 0
    const = df.withColumn("c", F.lit(7.0))
    sc = prep.Scaler.fit(const, ["a", "b", "c"])
    assert sc.std[2] == 0.0 and sc.scale[2] == 1.0
    z = sc.transform(const).toPandas()
    assert np.allclose(z.c, 0.0)
    assert np.isclose(z.a.mean(), 0.0) and np.isclose(z.a.std(ddof=0), 1.0)


def test_anti_plus_semi_is_input(spark):
    df = _features(spark)
    keys = spark.createDataFrame([(1, D(2024, 1, 11)), (3, D(2024, 1, 12)), (9, D(2024, 1, 1))],
                                 "CUSTOMER_ID long, GA_SESSIONS_DATE date")
    anti = prep.remove_labelled(df, keys)
    semi = df.join(keys, ["CUSTOMER_ID", "GA_SESSIONS_DATE"], "left_semi")
    assert anti.count() + semi.count() == df.count()
    assert sorted(anti.unionByName(semi).collect()) == sorted(df.collect())


def test_label_days_customer_source_and_window(spark):
    p = Params.testdata()
    orders = spark.createDataFrame(
        [(1, 10, dt.datetime(2024, 1, 12, 9)), (2, 10, dt.datetime(2024, 1, 12, 18)),
         (3, 11, dt.datetime(2024, 1, 30, 23, 59)), (4, 12, dt.datetime(2024, 1, 31, 0, 0)),
         (5, 13, dt.datetime(2024, 1, 9, 23, 0))],
        "order_id long, customer_id long, order_placed_dttm timestamp_ntz")
    ato = spark.createDataFrame([(1, 99), (2, 99), (3, 11), (4, 12), (5, 13)],
                                "order_id long, customer_id long")
    by_label = labels.label_days(labels.label_orders(ato, orders, p, "label"))
    got = {(r.customer_id, r.date): r.order_id for r in by_label.collect()}
    assert got == {(99, D(2024, 1, 12)): 2, (11, D(2024, 1, 30)): 3}
    by_orders = labels.label_orders(ato.select("order_id"), orders, p, "orders")
    assert {r.customer_id for r in by_orders.collect()} == {10, 11}


def test_sample_and_split_fractions(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("CUSTOMER_ID"),
                                      F.lit(D(2024, 1, 10)).alias("GA_SESSIONS_DATE"))
    n = prep.sample_rows(df, 0.2).count()
    assert n == 4000
    v = prep.with_split(df, 0.05).where("split = 'val'").count()
    assert v == 1000


def test_geo_city_from_json_struct_and_variant(spark):
    from dayguard.operators.staging import geo_city
    js = spark.createDataFrame([('{"city": "Oslo"}',), ("{}",)], "geo_network string")
    assert [r[0] for r in js.select(geo_city(js)).collect()] == ["Oslo", None]
    st = spark.createDataFrame([(("Oslo",),), ((None,),)], "geo_network struct<city: string>")
    assert [r[0] for r in st.select(geo_city(st)).collect()] == ["Oslo", None]
    va = js.select(F.parse_json("geo_network").alias("geo_network"))
    assert [r[0] for r in va.select(geo_city(va)).collect()] == ["Oslo", None]


def test_inputs_from_catalog_tables(spark):
    from dayguard.operators import assemble
    from dayguard.sources.tables import Inputs
    from dayguard.sources.testdata import load_inputs
    src = load_inputs(spark, "/root/testdata/sf0.001")
    names = {}
    for n in ("order_line", "orders", "product", "ga_sessions", "hits_products", "hits_union"):
        view = f"dg_{n}"
        getattr(src, n).createOrReplaceTempView(view)
        names[n] = view
    inp = Inputs.from_tables(spark, ato_orders=src.ato_orders, fraud_orders=src.fraud_orders, **names)
    p = Params.testdata()
    a = assemble.feature_table(inp, p)
    b = assemble.feature_table(src, p)
    assert a.count() == 258 and a.exceptAll(b).count() == 0


def test_daily_totals_match_distinct_count_form(spark):
    from dayguard.operators import basic
    from dayguard.sources.tables import Inputs
    p = Params.testdata()
    d1, d2 = dt.datetime(2024, 1, 10, 8), dt.datetime(2024, 1, 11, 9)
    from decimal import Decimal as Dec
    ol = spark.createDataFrame([
        (1, 100, 5, d1, "D", False, 2.0, Dec("1.50")), (1, 100, 5, d1, "D", None, 1.0, Dec("2.25")),
        (1, 101, None, d1, "X", False, 3.0, Dec("4.00")), (1, None, 6, d1, "D", True, None, Dec("1.00")),
        (2, 102, 7, d2, "D", False, 1.0, None), (None, 103, 8, d2, "D", False, 1.0, Dec("3.00"))],
        "customer_id long, order_id long, product_id long, order_placed_dttm timestamp_ntz, "
        "order_status string, order_auto_reorder_flag boolean, order_line_quantity double, "
        "order_line_total_price decimal(18,2)")
    hits = spark.createDataFrame([
        (1, D(2024, 1, 10), 5, True, "PAGE", "/p/5", "t"), (1, D(2024, 1, 10), 5, False, "PAGE", "/p/5", None),
        (1, D(2024, 1, 10), None, True, "EVENT", "/p/x", "t"), (2, D(2024, 1, 11), 7, False, "EVENT", "/p/7", "t"),
        (2, D(2024, 1, 11), None, None, "PAGE", "/p/9", "u")],
        "customer_id long, ga_sessions_date date, product_id long, is_click boolean, type string, "
        "page_path string, page_title string")
    inp = Inputs(order_line=ol, orders=None, product=None, ga_sessions=None, hits_products=None,
                 hits_union=hits, ato_orders=None, fraud_orders=None)
    ol.createOrReplaceTempView("t_ol")
    hits.createOrReplaceTempView("t_hits")
    one = "NOT order_auto_reorder_flag AND order_status = 'D'"
    want_o = spark.sql(f"""SELECT customer_id AS CUSTOMER_ID, to_date(order_placed_dttm) AS GA_SESSIONS_DATE,
        count(DISTINCT order_id) AS TOTAL_NUM_ORDERS,
        count(DISTINCT CASE WHEN {one} THEN order_id END) AS NUM_ONETIME_ORDERS,
        count(DISTINCT product_id) AS DISTINCT_PRODUCT_ORDERED,
        count(DISTINCT CASE WHEN {one} THEN product_id END) AS DISTINCT_PRODUCT_ONETIME_ORDERED,
        CAST(sum(CASE WHEN {one} THEN order_line_quantity ELSE 0 END) AS DOUBLE) AS ONETIME_ORDER_QUANTITY,
        CAST(sum(CASE WHEN order_status = 'D' THEN order_line_quantity ELSE 0 END) AS DOUBLE) AS TOTAL_ORDER_QUANTITY,
        CAST(sum(CASE WHEN order_status = 'D' THEN order_line_total_price ELSE 0 END) AS DOUBLE) AS TOTAL_ORDER_PRICE,
        CAST(sum(CASE WHEN {one} THEN order_line_total_price ELSE 0 END) AS DOUBLE) AS ONETIME_ORDER_PRICE
        FROM t_ol GROUP BY 1, 2""")
    got_o = basic.order_totals(inp, D(2024, 1, 1), D(2024, 1, 30), p)
    assert sorted(got_o.collect(), key=repr) == sorted(want_o.select(*got_o.columns).collect(), key=repr)
    want_h = spark.sql("""SELECT customer_id AS CUSTOMER_ID, ga_sessions_date AS GA_SESSIONS_DATE,
        count(DISTINCT product_id) AS DISTINCT_PRODUCT_HIT, count(product_id) AS TOTAL_PRODUCT_HIT,
        count(DISTINCT CASE WHEN is_click THEN product_id END) AS DISTINCT_PRODUCT_CLICKED,
        count(CASE WHEN is_click THEN product_id END) AS TOTAL_PRODUCT_CLICKED,
        CAST(sum(CASE type WHEN 'PAGE' THEN 1 END) AS BIGINT) AS TOTAL_PAGES_VIEWED,
        count(DISTINCT CASE type WHEN 'PAGE' THEN concat(page_path, ',', page_title) END) AS DISTINCT_PAGES_VIEWED
        FROM t_hits GROUP BY 1, 2""")
    got_h = basic.hit_totals(inp, D(2024, 1, 1), D(2024, 1, 30), p)
    assert sorted(got_h.collect(), key=repr) == sorted(want_h.select(*got_h.columns).collect(), key=repr)


def test_export_job_roundtrip_and_month_pruning(spark):
    from dayguard.operators import assemble
    from dayguard.plans import pipeline
    from dayguard.sources.testdata import load_inputs
    p = Params.testdata()
    inp = load_inputs(spark, "/root/testdata/sf0.001")
    out = pipeline.export_job(inp, p, _path(spark, "export"), max_records_per_file=100)
    back = pipeline.read_feature_months(spark, out["features"])
    ft = assemble.feature_table(inp, p)
    assert back.count() == 258 and back.exceptAll(ft).count() == 0
    assert pipeline.read_feature_months(spark, out["features"], ["2023-12"]).count() == 0
    ato = csvio.read_csv(spark, out["ato_rows"], csvio.FEATURE_SCHEMA)
    assert ato.count() == 13
    plan = pipeline.read_feature_months(spark, out["features"], ["2024-01"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01" in plan


def test_malformed_feature_rows_stop_the_read(spark, tmp_path):
    import pytest
    (tmp_path / "f.csv").write_text("order_id,customer_id\n1,2\nx,3\n")
    with pytest.raises(Exception, match="(?i)malformed|NumberFormat|FAILFAST|FAILED_READ"):
        csvio.read_csv(spark, str(tmp_path / "f.csv"), csvio.ATO_LABEL_SCHEMA).collect()
    assert csvio.read_csv(spark, str(tmp_path / "f.csv"), csvio.ATO_LABEL_SCHEMA, tolerant=True).count() == 2


def test_single_file_keeps_the_plan_parallel(spark, tmp_path):
    a = spark.range(100).withColumnRenamed("id", "k")
    j = a.repartition(4).join(a.repartition(4).hint("merge"), "k", "left_semi")
    path = csvio.write_csv(j, str(tmp_path / "one"), single_file=True)
    import glob
    assert len(glob.glob(f"{path}/*.csv")) == 1
    plan = j.repartition(1)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("RoundRobinPartitioning(1)") < plan.index("Join") if "RoundRobinPartitioning(1)" in plan else "SinglePartition" in plan


def test_equal_feature_rows_count_once(spark):
    from dayguard.plans.pipeline import distinct_features
    from dayguard.schema import FEATURES, KEY_COLS
    rows = spark.range(3).select(F.col("id").alias(KEY_COLS[0]), F.lit("2024-01-01").cast("date").alias(KEY_COLS[1]),
                                 *[F.when(F.col("id") < 2, 1).otherwise(2).alias(c) for c in FEATURES])
    assert rows.dropDuplicates().count() == 3 and distinct_features(rows).count() == 2
