"""The daily slice (A1), missing fields (I11) and audit rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cargolens.operators import freight, incremental, pipeline


def slice_inputs(spark):
    day = dt.date(2024, 5, 10)
    quotes = spark.createDataFrame(
        [(1, 1, day, None, "q1"), (2, 1, None, dt.datetime(2024, 5, 11, 1), "q2"), (3, 1, dt.date(2024, 5, 11), None, "q3"),
         (4, 2, day, None, "q1"), (5, 1, None, dt.datetime(2024, 5, 11, 9), "q5"), (6, 1, None, None, "q6")],
        "id long, company_id int, date date, quoted_at timestamp, quote_id string").withColumn(
        "channel", F.lit("c")).withColumn("destination_state", F.lit("SP")).withColumn("invoice_value", F.lit(10.0))
    options = spark.createDataFrame([(i, i, 0, 5.0, 3, "x") for i in range(1, 7)],
                                    "id long, freight_quote_id long, line_index int, shipping_value double, deadline int, carrier string")
    items = spark.createDataFrame([(i, i) for i in range(1, 7)], "quote_id long, product_id long")
    orders = spark.createDataFrame([(1, 1, "q1", 4.0), (2, 1, "q3", 4.0)], "id long, company_id int, quote_id string, freight_amount double")
    return quotes, options, items, orders


def test_daily_slice_equals_filtered_rollup(spark):
    inputs = slice_inputs(spark)
    whole = freight.freight_rollup(*inputs)
    for days, company in ((["2024-05-10"], 1), (["2024-05-10", "2024-05-11"], None), (None, 2), ([], None)):
        want = whole
        if days is not None:
            want = want.where(F.col("date").isin([dt.date.fromisoformat(d) for d in days]) if days else F.lit(False))
        if company is not None:
            want = want.where(F.col("company_id") == company)
        got = freight.freight_rollup(*inputs, days=days, company_id=company)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert freight.freight_rollup(*inputs, days=["2024-05-10"], company_id=1).agg(F.sum("total_simulations")).first()[0] == 2


def test_daily_slice_plan(spark, tmp_path):
    quotes, options, items, orders = slice_inputs(spark)
    quotes.write.parquet(str(tmp_path / "q"))
    stored = spark.read.parquet(str(tmp_path / "q"))
    plan = freight.freight_rollup(stored, options, items, orders, days=["2024-05-10"])._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("date" in p and "quoted_at" in p for p in pushed)
    assert plan.count("LeftSemi") >= 3


def test_backfill_scores_open_quotes_only(spark):
    quotes = spark.createDataFrame([(1, None, None), (2, 9.0, 9.0), (3, None, 1.0), (4, None, None)],
                                   "id long, best_deadline double, best_freight_cost double")
    options = spark.createDataFrame([(1, 0, 4.0, 2.0), (2, 0, 1.0, 1.0), (3, 0, 5.0, 6.0)],
                                    "freight_quote_id long, line_index int, carrier_deadline double, price double")
    got = {r.id: tuple(r)[1:] for r in incremental.backfill_best_option(quotes, options).collect()}
    assert got == {1: (4.0, 2.0), 2: (9.0, 9.0), 3: (5.0, 6.0), 4: (None, None)}


def test_audit_rows(spark):
    seen = []
    record = lambda row: seen.append(row.first())
    metrics = {"n": F.count(F.lit(1))}
    noop = lambda d: d.write.format("noop").mode("overwrite").save()
    pipeline.audited_write(spark, spark.range(5), noop, 7, "orders", metrics, record)
    assert [(r.status, r.counters) for r in seen] == [("PROCESSANDO", {}), ("FINALIZADO", {"n": 5})]

    def broken(d):
        raise ValueError("x" * 5000)

    with pytest.raises(ValueError):
        pipeline.audited_write(spark, spark.range(5), broken, 7, "orders", metrics, record)
    assert [r.status for r in seen[2:]] == ["PROCESSANDO", "ERRO"] and len(seen[3].errors) > 5000
