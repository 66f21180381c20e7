"""Streaming sinks: a replayed epoch rewrites the same output, and the
cursor sink only passes rows newer than the cursor of their key."""

import datetime as dt

from pyspark.sql import functions as F

from cargolens.streaming import micro_batch as mb


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_if_absent_replay_is_idempotent(spark):
    target = mb.scratch_path(spark, "t-insert")
    sink = mb.insert_if_absent_sink(spark, target, ["k"], ["ts"], ["k", "ts", "v"])
    b0 = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (2, 2, "c")], "k int, ts int, v string")
    b1 = spark.createDataFrame([(2, 3, "x"), (3, 1, "d")], "k int, ts int, v string")
    sink(b0, 0)
    sink(b1, 1)
    first = _rows(spark.read.parquet(target).drop("epoch"))
    sink(b1, 1)  # replay after a failure
    assert _rows(spark.read.parquet(target).drop("epoch")) == first == [(1, 1, "a"), (2, 1, "b"), (3, 1, "d")]


def test_cursor_sink(spark):
    passed, cursor = mb.scratch_path(spark, "t-passed"), mb.scratch_path(spark, "t-cursor")
    t = lambda d: dt.datetime(2024, 1, d)
    initial = spark.createDataFrame([("a", t(5))], "company string, last_processed_at timestamp_ntz")
    sink = mb.cursor_sink(spark, passed, cursor, ["company"], "synced_at", initial)
    schema = "company string, id int, synced_at timestamp_ntz"
    sink(spark.createDataFrame([("a", 1, t(4)), ("a", 2, t(6)), ("b", 3, t(1))], schema), 0)
    sink(spark.createDataFrame([("a", 4, t(6)), ("a", 5, t(7)), ("b", 6, t(1)), ("b", 7, t(2))], schema), 1)
    got = sorted(r.id for r in spark.read.parquet(passed).collect())
    assert got == [2, 3, 5, 7]
    cur = spark.read.parquet(cursor).where(F.col("epoch") == 1).orderBy("company").collect()
    assert [(r.company, r.last_processed_at) for r in cur] == [("a", t(7)), ("b", t(2))]


def test_slice_refresh_replay(spark):
    target = mb.scratch_path(spark, "t-slices")
    data = spark.createDataFrame([("x", 1, 10), ("x", 2, 5), ("y", 1, 7)], "company string, day int, v int")

    def compute(touched):
        return data.join(touched, ["company", "day"], "left_semi").groupBy("company", "day").agg(F.sum("v").alias("v"))

    sink = mb.slice_refresh_sink(spark, target, ["company", "day"], compute)
    sink(data.where("company = 'x'"), 0)
    sink(data.where("company = 'y'"), 1)
    sink(data.where("company = 'y'"), 1)
    assert _rows(spark.read.parquet(target).select("company", "day", "v")) == [("x", 1, 10), ("x", 2, 5), ("y", 1, 7)]


def test_slice_refresh_leaves_no_shuffle_files(spark):
    """the shuffles of every epoch stayed on disk beside those of the next."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: set(disk.getAllFiles().mkString("\n").split("\n"))
    target = mb.scratch_path(spark, "t-shuffles")
    data = spark.range(4000).selectExpr("concat('c', id % 3) as company", "cast(id % 5 as int) as day", "id as v")
    sink = mb.slice_refresh_sink(spark, target, ["company", "day"], lambda touched: (
        data.join(touched.hint("merge"), ["company", "day"], "left_semi").groupBy("company", "day").agg(F.sum("v").alias("v"))))
    before = files()
    sink(data, 0)
    assert not {f for f in files() - before if "shuffle_" in f}
    assert spark.read.parquet(target).agg(F.sum("v")).first()[0] == sum(range(4000))


def test_a_rollup_in_portions_is_the_whole_rollup(spark):
    """quotes are dealt to portions by the hash of their id; none is left out or counted twice."""
    from cargolens.operators import freight as fr
    day = dt.date(2024, 1, 1)
    quotes = spark.createDataFrame([(None if i == 7 else i % 90, i % 3, None if i % 11 == 0 else day, dt.datetime(2024, 1, 1 + i % 4, 5), "web", "sp", None if i == 8 else str(i), 8.0 * i)
                                    for i in range(100)],
                                   "id long, company_id int, date date, quoted_at timestamp, channel string, destination_state string, quote_id string, invoice_value double")
    options = spark.createDataFrame([(i, None if i == 3 else i % 80, i % 4, None if i % 9 == 0 else i % 7 + 1.0, i % 5, f" c{i % 3} ") for i in range(300)],
                                    "id long, freight_quote_id long, line_index int, shipping_value double, deadline int, carrier string")
    items = spark.createDataFrame([(None if i == 5 else i % 70, None if i % 13 == 0 else i % 4) for i in range(300)], "quote_id int, product_id int")
    orders = spark.createDataFrame([(i, i % 3, None if i == 2 else str(i), 4.0 * i) for i in range(0, 100, 2)], "id long, company_id int, quote_id string, freight_amount double")
    sums = ("total_value_simulations", "total_value_orders")
    bag = lambda df: sorted(map(str, df.select(*[F.round(c, 6) if c in sums else c for c in df.columns]).collect()))
    whole, cut = fr.freight_rollup(quotes, options, items, orders), fr.rollup_in_portions(quotes, options, items, orders, quotes_each=30)
    assert cut.schema.simpleString() == whole.schema.simpleString() and "rollup-portion" in cut.inputFiles()[0]
    assert bag(cut) == bag(whole) and whole.count() > 20
