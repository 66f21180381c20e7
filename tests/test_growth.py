"""What must not grow faster than the input: candidate pairs, tasks, passes."""

import hashlib
import random

from pyspark.sql import functions as F

from cargolens.operators import stock as sk


def _texts(spark, column, texts):
    return spark.createDataFrame([(x,) for x in sorted(texts)], f"{column} string")


def test_short_carriers_meet_only_terms_nearly_alike(spark):
    """Order numbers and hashed names share pieces of two characters, but are not alike."""
    hashed = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    names = {hashed(i)[:6] + " log" for i in range(400)} | {hashed(-i - 1)[:8] for i in range(400)}
    carriers = {f"zz{100000 + 7 * i}" for i in range(3000)} | {x[:3] + x[4:] for x in names}
    pairs = sk.candidate_pairs(_texts(spark, "c", carriers), _texts(spark, "t", names))
    rule = sk.carrier_matches(F.col("c"), F.col("t"))
    assert pairs.where(rule).count() >= len(names)
    assert pairs.count() < 2 * len(carriers)


def test_edits_of_short_texts_are_all_found(spark):
    rng = random.Random(8)
    texts = {"".join(rng.choice("ab ") for _ in range(n)).strip() for n in range(1, 17) for _ in range(12)} - {""}

    def edited(s):
        for _ in range(rng.randint(0, 2)):
            p = rng.randint(0, len(s))
            s = s[:p] + rng.choice(["", "a", "é"]) + s[p + rng.randint(0, 1):]
        return s
    c, t = _texts(spark, "c", {edited(s) for s in sorted(texts) for _ in range(3)} - {""}), _texts(spark, "t", texts)
    rule = sk.carrier_matches(F.col("c"), F.col("t"))
    assert sorted(map(tuple, sk.candidate_pairs(c, t).where(rule).collect())) == sorted(map(tuple, c.join(t, rule).collect()))


def test_carriers_and_terms_are_made_once(spark, monkeypatch):
    """The blocking reads the written texts, dealt over all tasks; nothing makes the carriers again."""
    written = {}
    keep = sk.write_once
    monkeypatch.setattr(sk, "write_once", lambda df, name: written.setdefault(name, keep(df, name)))
    carriers = spark.range(300).selectExpr("if(id % 50 = 0, null, concat('carrier ', id % 100)) as carrier", "id % 3 as origin_id")
    operators = spark.range(20).selectExpr("id as operator_id", "id + 1000 as company_id", "concat('Carrier ', id) as company_name",
                                           "concat('carrier-', id) as slug", "array('', null, concat('c', id)) as synonyms")
    found = sk.match_operators(carriers, operators)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 300") == 0 and plan.count("Range (0, 20") == 1        # 1: the names of the operators
    files = [len(written[name].inputFiles()) for name in ("carrier-texts", "operator-texts")]
    assert min(files) > 1
    assert found.count() > 0 and found.where("carrier_norm is null").count() == 0


def test_no_side_of_the_blocking_is_broadcast(spark):
    """F1-F8: a text explodes to dozens of keys, which the planner does not count; the driver gathered all of them."""
    names = sorted(f"{hashlib.md5(str(i).encode()).hexdigest()[:6]} log" for i in range(50)) + ["transportes sul", "transportes sul ltda"]
    c, t = _texts(spark, "c", [x[:3] + x[4:] for x in names]), _texts(spark, "t", names)
    pairs = sk.candidate_pairs(c, t).where(sk.carrier_matches(F.col("c"), F.col("t")))
    assert pairs.count() >= len(names)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    carriers = spark.createDataFrame([(x, 1) for x in names], "carrier string, origin_id int")
    operators = spark.createDataFrame([(i, i + 1000, x, None, None) for i, x in enumerate(names)],
                                      "operator_id int, company_id int, company_name string, slug string, synonyms array<string>")
    found = sk.match_operators(carriers, operators)
    assert found.count() == len(names)
    held = [x for x in found._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[1:] if "Generate" in x.split("Join")[0]]
    assert not held


def test_documents_are_dealt_over_all_tasks(spark, tmp_path):
    """A file of one row group is read by one task, the documents are not made by it."""
    from cargolens.plans import q_staged as qs
    spark.range(100).selectExpr("id as k").coalesce(1).write.parquet(f"{tmp_path}/one")
    objs = qs.objects_of(spark.read.parquet(f"{tmp_path}/one"), '{"id": «k»}', k="k")
    sizes = [r["count"] for r in objs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_picked_field_is_decoded_once(spark):
    from cargolens.operators import staging as st
    from cargolens.sources import payload as pl
    reads = lambda c: str(c).count("try_variant_get(")
    for pick in (pl.pick_string, pl.pick_number, pl.pick_object, st.numeric_text):
        assert reads(pick(F.col("obj"), "$.a")) == 1
    assert reads(st.sql_datetime(pl.pick_string(F.col("obj"), "$.a"))) == 1


def test_an_object_is_decoded_in_one_pass(spark):
    """A path of its own walks the object again for each field, and a missing one raises inside Spark."""
    from cargolens.operators import staging as st
    from cargolens.sources import payload as pl
    objs = pl.expand_objects(pl.parse_payloads(spark.createDataFrame([("{}",)], "text string")))
    quotes, orders = st.stage_freight_quotes(objs), st.stage_freight_orders(objs)
    for staged in (quotes, orders, st.stage_precode_orders(objs), st.stage_panorama_orders(objs), st.stage_anymarket_orders(objs),
                   st.stage_tray_orders(objs, 2026), st.stage_bookings(objs, objs.withColumn("event_id", F.lit("1")))):
        assert staged._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get(") <= 18


def test_decoded_fields_are_what_the_pickers_give(spark):
    from cargolens.sources import payload as pl
    texts = ['{"a": " x ", "n": "1.50", "o": {"b": 2, "c": [{"d": 1.50}, 3, null, {"d": " "}]}, "t": true}', '{"a": "", "n": "NaN", "o": [], "t": 1}',
             '{"a": {"z": 1}, "n": 1e3, "o": {"b": null, "c": {}}}', '{"a": [1, "é"], "n": true, "o": {"c": []}, "A": 5}', "{}", "[]", "7", '"a"', '{"o": null}']
    objs = pl.expand_objects(pl.parse_payloads(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")))
    v, f = F.col("obj"), pl.Fields()
    read = lambda x: [pl.pick_string(x, "$.a"), pl.pick_number(x, "$.n"), pl.pick_string(x, "$.o.b"), pl.pick_string(x, "$.o.c[0].d"),
                      pl.pick_string(x, "$.missing.b"), pl.pick_object(x, "$.o").isNotNull()]
    rows = f.rows("$.o.c", lambda i, x: F.struct(i.alias("i"), x.text("d").alias("d")))
    decoded = read(f)
    part = F.to_json(f.part("$.o"))
    got = f.decode(objs, v).select("i", "obj_pos", *decoded, rows, part, F.to_json(F.try_variant_get(v, "$.o", "variant")), *read(v)).collect()
    assert len(got) == len(texts) - 1           # an empty page has no objects
    for r in got:
        assert tuple(r[2:8]) == tuple(r[11:]) and r[9] == r[10], r
    assert [[tuple(x) for x in r[8]] for r in got if r["i"] in (0, 1)] == [[(0, "1.5"), (3, None)], []]


def test_items_move_once_to_their_products(spark):
    """the key lookups run on distinct keys, not on every item."""
    from cargolens.operators import lookup as lk
    items = spark.range(400).selectExpr("id as at", "cast(id % 3 as int) as company_id", "if(id % 5 = 0, null, string(id % 7)) as ecommerce_id",
                                        "if(id % 2 = 0, concat('E', id % 4), ' ') as ean", "if(id % 3 = 0, null, 'S') as sku",
                                        "string(id % 2) as order_code", "'n' as name", "1.0D as unit_price")
    products = spark.sql("select 5L as product_id, 1 as company_id, '3' as ecommerce_id, 'E0' as ean, cast(null as string) as sku")
    got, new = lk.create_missing_products(items, products, ["at"])
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Range (0, 400") == 1 and text.count("Join ") == 4
    rows, made = {r["at"]: r for r in got.collect()}, new.collect()
    assert len(rows) == 400 and all(r["product_id"] is not None for r in rows.values())
    assert len({r["product_id"] for r in rows.values()} - {5}) == len(made)
    known = {}                                  # the same, one item after the other
    for k, v in (("ecommerce_id", "3"), ("ean", "E0")):
        known[1, k, v] = 5
    ids = {}
    for at in range(400):
        r = rows[at]
        e, n = r["ecommerce_id"], (r["ean"].strip() or None)
        keys = [(r["company_id"], k, v) for k, v in (("ecommerce_id", e), ("ean", n), ("sku", r["sku"] or e or r["order_code"])) if v]
        hit = next((known[k] for k in keys if k in known), None)
        if hit is None:
            hit = ("new", at)
            for k in keys:
                known.setdefault(k, hit)
        assert ids.setdefault(hit, r["product_id"]) == r["product_id"]


def test_landed_files_do_not_grow_with_the_tasks(spark, tmp_path, monkeypatch):
    """every micro-batch refreshes whole slices, so the batches must be few."""
    import os

    from cargolens.plans import q_stream
    from cargolens.sources.tables import TABLES
    from tests.conftest import SF_SMALL
    for name in TABLES:
        os.symlink(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    os.unlink(tmp_path / "orders.parquet")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(12).write.parquet(f"{tmp_path}/orders.parquet")
    landed = []

    class Stop(Exception):
        pass

    def stop(spark, path, *args, **more):
        landed.append(path)
        raise Stop
    monkeypatch.setattr(q_stream.mb, "file_stream", stop)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))       # a task per file
    try:
        q_stream.st01_stream_freight_rollup(spark, str(tmp_path))
    except Stop:
        pass
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    files = spark.read.parquet(landed[0]).select("year", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("year").count().agg(F.max("count")).first()[0] <= 4
