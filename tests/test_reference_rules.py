"""Rules that need more than one table or run: new products (J7), carrier
index (J13), slice commits (S9), entity sync (I18), header check (J1),
streams with bounded state, and small text rules (N25, P3, A4, N34)."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cargolens.functions import freight_labels, mapping, text
from cargolens.operators import lookup as lk
from cargolens.operators import orders as od
from cargolens.operators import slices as sl
from cargolens.operators import staging as st
from cargolens.operators import stock as sk
from cargolens.operators import upsert as up
from cargolens.plans import q_keys, q_staged
from cargolens.sources.tables import Tables
from cargolens.streaming import micro_batch as mb
from tests.conftest import SF_SMALL


def one_by_one(items, products):
    """J7 as a loop: (product key per item, new products in order)."""
    by = {k: {} for k in ("e", "a", "s")}
    for pid, c, e, a, s in products:
        for k, v in (("e", e), ("a", a), ("s", s)):
            if v:
                by[k][c, v] = max(by[k].get((c, v), pid), pid)
    made, out = [], []
    for c, e, a, s, code in items:
        s = s or e or code
        hit = next((by[k][c, v] for k, v in (("e", e), ("a", a), ("s", s)) if v and (c, v) in by[k]), None)
        if hit is None:
            hit = ("new", c, s)
            made.append((c, e, a, s))
            for k, v in (("e", e), ("a", a), ("s", s)):
                if v:
                    by[k][c, v] = hit
        out.append(hit)
    return out, made


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_new_products_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    pick = lambda p, n: rng.choice([None, "", " "]) if rng.random() < .4 else f"{p}{rng.randint(1, n)}"
    clean = lambda x: (x or "").strip() or None
    items = [(rng.randint(1, 2), pick("e", 15), pick("a", 15), pick("s", 15), f"o{rng.randint(1, 20)}") for _ in range(300)]
    products = [(i + 1, rng.randint(1, 2), clean(pick("e", 30)), clean(pick("a", 30)), clean(pick("s", 30))) for i in range(12)]
    want, made = one_by_one([(c, clean(e), clean(a), clean(s), o) for c, e, a, s, o in items], products)
    df = spark.createDataFrame([(n, *r, f"n{n}", float(n)) for n, r in enumerate(items)],
                               "at long, company_id int, ecommerce_id string, ean string, sku string, order_code string, name string, unit_price double")
    stored = spark.createDataFrame(products, "product_id long, company_id int, ecommerce_id string, ean string, sku string")
    linked, new = lk.create_missing_products(df.repartition(5), stored, ["at"])
    rows = new.collect()
    assert sorted((r.company_id, r.ecommerce_id or "", r.ean or "", r.sku) for r in rows) == sorted((c, e or "", a or "", s) for c, e, a, s in made)
    assert sorted(r.product_id for r in rows) == list(range(13, 13 + len(made)))
    ids = {("new", r.company_id, r.sku): r.product_id for r in rows}
    assert [r.product_id for r in sorted(linked.collect(), key=lambda r: r.at)] == [ids.get(w, w) for w in want]
    again = lk.create_missing_products(df.repartition(3), stored, ["at"])[1]
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    whole = stored.unionByName(new.select(*stored.columns))
    assert lk.create_missing_products(df, whole, ["at"])[1].count() == 0          # a rerun inserts nothing


def test_carrier_keys_are_few_and_complete(spark):
    rng = random.Random(4)
    words = "transportadora expresso rapido nordeste sul cargas ltda brasil log".split()
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(60)} | {"a", "ab", "abc", "abcd", "abcdefg", "abcdefgh"}

    def edited(s):
        for _ in range(rng.randint(0, 3)):
            p = rng.randint(0, len(s))
            s = s[:p] + rng.choice(["", "x", "y"]) + s[p + rng.randint(0, 1):]
        return s
    others = {edited(s) for s in sorted(names) for _ in range(4)} | {s + " filial" for s in names} | {s[3:] for s in names}
    c = spark.createDataFrame([(s,) for s in sorted(others) if s], "c string")
    t = spark.createDataFrame([(s,) for s in sorted(names)], "t string")
    rule = sk.carrier_matches(F.col("c"), F.col("t"))
    every = Counter(map(tuple, c.join(t, rule).collect()))            # the whole product, in the test only
    found = sk.candidate_pairs(c, t)
    assert Counter(map(tuple, found.where(rule).collect())) == every
    long = spark.createDataFrame([("x" * 5 + " ".join(words * 3)[:105],)], "s string")
    keys = long.select(F.size(sk._probe_keys(F.col("s"))) + F.size(sk._segment_keys(F.col("s"))) + F.size(sk._grams(F.col("s")))).first()[0]
    assert keys < 110 + 80


def test_a_killed_commit_leaves_the_old_state(spark):
    path = mb.scratch_path(spark, "killed")
    rows = lambda v: spark.createDataFrame([(1, "a", v), (2, None, v)], "id int, day string, value int")
    sl.commit_slices(rows(1), path, ["day"])
    rows(2).withColumn(sl.COMMIT, F.lit("dead")).write.parquet(f"{path}/data/dead")              # data written, then the job dies
    os.makedirs(f"{path.removeprefix('file:')}/manifest/version=1/_temporary/0")                   # or dies while the manifest is written
    state = lambda: sorted((r.id, r.day, r.value) for r in sl.read_slices(spark, path, ["day"]).collect())
    assert state() == [(1, "a", 1), (2, None, 1)]
    sl.commit_slices(rows(3).where("day is null"), path, ["day"])
    assert state() == [(1, "a", 1), (2, None, 3)]
    none = rows(9).limit(0)
    sl.commit_slices(none, path, ["day"], spark.createDataFrame([("a",)], "day string"))
    assert state() == [(2, None, 3)]
    assert sl.read_slices(spark, mb.scratch_path(spark, "nothing"), ["day"]) is None


def test_entity_sync_is_repeatable(spark):
    t = Tables(spark, SF_SMALL)
    store = q_keys.erp_store(spark, SF_SMALL)
    names = ["representatives", "customers_group", "customers", "products", "orders", "order_items"]
    before = {n: Counter(map(str, store.read(n).collect())) for n in names}
    sl.sync_erp(store, q_keys.erp_input(t, 2))
    reader = sl.SnapshotStore(spark, store.path)
    assert {n: Counter(map(str, reader.read(n).collect())) for n in names} == before              # unpublished: not seen
    store.commit()
    assert {n: Counter(map(str, sl.SnapshotStore(spark, store.path).read(n).collect())) for n in names} == before


def test_items_without_headers_are_an_error(spark):
    items = spark.createDataFrame([(1,)], "ref int")
    headers = spark.createDataFrame([(2,)], "key int")
    with pytest.raises(ValueError):
        lk.require_matches(lk.header_item_join(headers, items, "key", "ref", ["key"])[0], items)
    assert lk.require_matches(items.limit(0), items.limit(0)).count() == 0


def test_state_of_overlapping_pulls_stays_small(spark):
    landing = mb.scratch_path(spark, "pulls-landing")
    day0 = dt.datetime(2024, 1, 1)
    schema = "id long, ts timestamp"
    for day in range(20):                   # each pull brings its day and the day before
        rows = [(d * 100 + i, day0 + dt.timedelta(days=d, minutes=i)) for d in (day - 1, day) if d >= 0 for i in range(100)]
        rows += [(i, day0 + dt.timedelta(minutes=i)) for i in range(5)] if day == 15 else []        # late duplicates
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    stream = mb.distinct_pulls(mb.file_stream(spark, landing, spark.createDataFrame([], schema).schema, max_files=1), ["id"], "ts", "2 days")
    target = mb.scratch_path(spark, "pulls-out")
    progress = mb.append_available(stream, target, mb.scratch_path(spark, "pulls-ckpt"))
    out = spark.read.parquet(target)
    assert (out.count(), out.select("id").distinct().count()) == (2000, 2000)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) <= 600


def test_plans_of_child_tables_parse_nothing(spark):
    staged = q_staged._tray_orders(spark, SF_SMALL)
    for child in (st.child(staged, "order"), st.child_lines(staged, ("order.external_id",)), q_staged._quotes(spark, SF_SMALL).select("quote.*")):
        plan = child._jdf.queryExecution().executedPlan().toString()
        assert "parse_json" not in plan.lower() and "variant_get" not in plan.lower()
    objs = q_staged.objects_of(Tables(spark, SF_SMALL).orders, q_staged.QUOTE, k="o_orderkey", c="o_custkey", m="1", ch="o_orderpriority",
                               total="o_totalprice", value="1", day=q_staged.DAY)
    plan = st.stage_freight_quotes(objs)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parse_json(") + plan.count("parsejson") <= 2             # once, in the generator's input


def test_text_rules(spark):
    df = spark.createDataFrame([("škoda",), ("ŽÅ",), ("cafés",), ("Ệ & ŵ",), (None,), ("ação--X",)], "s string")
    assert [r[0] for r in df.select(text.category_key(F.col("s"))).collect()] == ["skoda", "za", "cafes", "e w", "", "acao x"]
    one = spark.createDataFrame([("baab",)], "s string")
    clean = lambda regex, m: one.select(mapping.regex_clean(F.col("s"), {"regex": regex, "map": m}, spark=spark)).first()[0]
    assert clean("a*", {"aa": "X"}) == "baab" and clean("a+", {"aa": "X"}) == "bXb" and clean("b", {"b": None}) == "aa"
    lines = spark.createDataFrame([(1, "1", "0,1"), (1, "1", "0,2"), (1, "1", "0,3"), (2, "x", "1")], "k int, q string, p string")
    assert {r.k: r.total_from_lines for r in od.order_total_from_lines(lines, "k", "q", "p").collect()} == {1: 0.6, 2: None}
    days = spark.createDataFrame([(float(x),) for x in (-1, 0, 5, 5.5, 10, 45, 46, 60, 61)], "d double")
    assert [r[0] for r in days.select(freight_labels.deadline_bucket(F.col("d"))).collect()] == [
        ">0", ">0", ">0", ">5", ">5", ">40", ">45", ">45", ">60"]


def test_null_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    incoming = spark.createDataFrame([(1, "b", 1), (1, None, 2), (2, "c", 1), (2, "d", 2), (None, "m", 1)], "k int, v string, at int")
    rows = lambda df, *c: sorted(map(str, map(tuple, df.select(*c).collect())))
    assert rows(up.upsert(target, incoming, ["k"], order=["at"]), "k", "v") == rows(
        spark.createDataFrame([(1, "b"), (2, "d"), (None, "m")], "k int, v string"), "k", "v")
    assert rows(up.insert_if_absent(target, incoming, ["k"], order=["at"]), "k", "v") == rows(
        spark.createDataFrame([(1, "a"), (None, "n"), (2, "c")], "k int, v string"), "k", "v")
    new, skipped = up.only_insert(target, incoming, ["k"], order=["at"])
    assert (new.count(), skipped.count()) == (1, 3)
    kept = up.replace_slices(target, incoming.where("k is null").select("k", "v"), ["k"])
    assert rows(kept, "k", "v") == rows(spark.createDataFrame([(1, "a"), (None, "m")], "k int, v string"), "k", "v")
