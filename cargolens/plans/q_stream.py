"""Streaming forms checked against their batch oracles:
rows land as many small files, a file stream processes them in several
micro-batches, and the sink's final content must equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import freight as fr
from cargolens.plans import bindings as b
from cargolens.plans.q_freight import a1_rollup  # noqa: F401  (same output shape)
from cargolens.plans.q_freight import BUCKET_SQL, FREIGHT_CTES, RANGE_SQL
from cargolens.plans.registry import query
from cargolens.sources import payload as pl
from cargolens.sources.tables import Tables
from cargolens.streaming import micro_batch as mb

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("st07_stream_insert_if_absent", oracle="""
select distinct event_id, ts, user_id, event_type, value, props from events
""")
def st07_stream_insert_if_absent(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(*EVENT_COLS)
    replays = e.where(F.col("event_id") % 10 == 0)  # the same rows landed again (overlapping look-back)
    landing = mb.scratch_path(spark, "landing-events")
    mb.land_files(e.unionByName(replays), landing, F.date_format("ts", "yyyyMMdd"), "day")
    target = mb.scratch_path(spark, "events-target")
    stream = mb.file_stream(spark, landing, e.schema, max_files=60)
    mb.run_available(stream, mb.insert_if_absent_sink(spark, target, ["event_id"], ["ts", "value"], EVENT_COLS),
                     mb.scratch_path(spark, "ckpt-events"))
    return spark.read.parquet(target).select(*EVENT_COLS)


@query("st01_stream_freight_rollup", oracle=f"""
with {FREIGHT_CTES}
select q.company_id, q.date, trim(q.channel) as channel, upper(trim(q.state)) as state,
 {RANGE_SQL.format(v='b.shipping_value')} as freight_range,
 {BUCKET_SQL.format(d='b.deadline')} as deadline_bucket,
 coalesce(trim(b.carrier),'') as courier, l.product_id,
 count(*) as total_simulations, count(f.quote_id) as total_orders,
 round(sum(q.invoice_value/l.n),6) as total_value_simulations,
 round(sum(coalesce(f.freight_amount,0)/l.n),6) as total_value_orders
from quotes q join lines l on l.id=q.id left join best b on b.quote_id=q.id left join ford f on f.quote_id=q.id
group by all
""")
def st01_stream_freight_rollup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    quotes = b.freight_quotes(t)
    landing = mb.scratch_path(spark, "landing-quotes")
    # a year lands in at most 4 files, however many tasks read the quotes: every micro-batch
    # refreshes whole slices, so their number must not grow with the input
    year = F.date_format("quoted_at", "yyyy")
    mb.land_files(quotes.repartition(28, year, F.pmod(F.xxhash64("id"), F.lit(4))), landing, year, "year")
    options, items, orders = b.freight_options(t), b.freight_items(t), b.freight_orders(t)
    target = mb.scratch_path(spark, "freight-resume")

    def compute(touched):
        landed = spark.read.parquet(landing).drop("year")
        slice_quotes = landed.join(touched.withColumnRenamed("date", "_d").withColumnRenamed("company_id", "_c"),
                                   (F.col("company_id") == F.col("_c")) & (F.col("date") == F.col("_d")), "left_semi")
        return fr.rollup_in_portions(slice_quotes, options, items, orders)

    stream = mb.file_stream(spark, landing, spark.read.parquet(landing).schema, max_files=16)
    mb.run_available(stream, mb.slice_refresh_sink(spark, target, ["company_id", "date"], compute),
                     mb.scratch_path(spark, "ckpt-resume"))
    r = spark.read.parquet(target)
    return r.select(F.col("company_id").cast("int").alias("company_id"), F.col("date").cast("date").alias("date"),
                    "channel", "state", "freight_range", "deadline_bucket", "courier", "product_id",
                    "total_simulations", "total_orders",
                    F.round("total_value_simulations", 6).alias("total_value_simulations"),
                    F.round("total_value_orders", 6).alias("total_value_orders"))


# Landed text pages: a broken line on every 11th order, a page of two objects on every 4th.

def _landed_pages(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k = F.col("o_orderkey").cast("string")
    text = (F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("broken {"), k))
            .when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('[{"id": '), k, F.lit(', "ok": True}, {"id": "'), k, F.lit('-b"}]')))
            .otherwise(F.concat(F.lit('x {"id": '), k, F.lit(', "total": float( '), F.col("o_totalprice").cast("string"), F.lit(")}"))))
    landing = mb.scratch_path(spark, "landing-pages")
    o.select(text.alias("value")).repartition(6).write.text(landing)
    stream = pl.read_landed(spark, landing, stream=True, max_files=4)
    objects, bad = mb.scratch_path(spark, "page-objects"), mb.scratch_path(spark, "page-quarantine")
    mb.run_available(stream, mb.payload_sink(spark, objects, bad, repair=True), mb.scratch_path(spark, "ckpt-pages"))
    return spark.read.parquet(objects), spark.read.parquet(bad)


@query("s02_stream_landing", oracle="""
select cast(o_orderkey as varchar) as external_id, 0 as obj_pos, case when o_orderkey % 4 <> 0 then o_totalprice end as total from orders where o_orderkey % 11 <> 0
union all select cast(o_orderkey as varchar) || '-b', 1, null from orders where o_orderkey % 11 <> 0 and o_orderkey % 4 = 0
""")
def s02_stream_landing(spark, sf_dir):
    v = F.try_parse_json("obj")
    return _landed_pages(spark, sf_dir)[0].select(pl.pick_string(v, "$.id").alias("external_id"), "obj_pos", pl.pick_number(v, "$.total").alias("total"))


@query("s03_stream_quarantine", oracle="""
select 'broken {' || cast(o_orderkey as varchar) as text, true as has_file, true as has_line from orders where o_orderkey % 11 = 0
""")
def s03_stream_quarantine(spark, sf_dir):
    return _landed_pages(spark, sf_dir)[1].select("text", F.col("source_file").contains("landing-pages").alias("has_file"),
                                                  (F.col("line") >= 0).alias("has_line"))


@query("st10_overlapping_pulls", oracle="""
select event_id, ts, user_id, event_type, value from events
""")
def st10_overlapping_pulls(spark, sf_dir):
    """Three pulls, each with the last two days of the one before and, the
    last, a replay of the very first day."""
    e = Tables(spark, sf_dir).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    step, day = (hi - lo) / 3, F.expr("interval 1 day")
    landing = mb.scratch_path(spark, "landing-pulls")
    for n in range(3):
        begin, end = F.lit(lo + n * step), F.lit(lo + (n + 1) * step)
        pull = (F.col("ts") >= begin - 2 * day) & ((F.col("ts") < end) if n < 2 else F.lit(True))
        if n == 2:
            pull = pull | (F.col("ts") < F.lit(lo) + day)
        e.where(pull).coalesce(1).write.mode("append").parquet(landing)
    stream = mb.distinct_pulls(mb.file_stream(spark, landing, e.schema, max_files=1), ["event_id"], "ts", "3 days")
    target = mb.scratch_path(spark, "pulls")
    mb.append_available(stream, target, mb.scratch_path(spark, "ckpt-pulls"))
    return spark.read.parquet(target).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
