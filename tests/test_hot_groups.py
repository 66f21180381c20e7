"""Operators that split hot groups: the money waterfall (W7) against its
loop, best option (W2) and sku conflicts (W5) with a hot key."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cargolens.operators import dedupe as dd
from cargolens.operators import freight as fr
from cargolens.operators import running as rn

AMOUNTS = ["10", "0.1", "0.005", "-3.335", "7.777", "100.004", "-0.01", "1e1", "x", None, "", "0", "12,5", "33.33", "5"]


def money(x):
    """Leading number of the text, rounded half up to cents; in whole cents."""
    text = str(x or "").replace("12,5", "12")
    try:
        value = float(text)
    except ValueError:
        value = 0.0
    return math.floor(value * 100 + 0.5)


def loop(lines, discount):
    """Cents of each (value, flag) line after the discount, line by line."""
    out = [money(v) for v, _ in lines]
    remaining = money(discount)
    for i in sorted(range(len(out)), key=lambda i: (not lines[i][1], -out[i], i)):
        if remaining <= 0:
            break
        taken = min(remaining, out[i])
        out[i] -= taken
        remaining -= taken
    return out


@pytest.mark.parametrize("groups, longest, threshold", [(100_000, 4, 10 ** 9), (300, 60, 10), (1, 4000, 10), (2, 1000, 1500)])
def test_waterfall_equals_loop(spark, groups, longest, threshold):
    rng = random.Random(groups)
    rows, want = [], {}
    for g in range(groups):
        lines = [(rng.choice(AMOUNTS), rng.random() < .2) for _ in range(rng.randint(1, longest) if groups > 2 else longest)]
        discount = rng.choice([None, "0", "-5", "abc", "0.01", "7", "33.335", str(longest * 3), "1e6"])
        key = None if g == 1 else g
        rows += [(key, i, v, f, discount) for i, (v, f) in enumerate(lines)]
        want[key] = loop(lines, discount)
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string()))],
                     names=["g", "i", "value", "flag", "discount"])
    df = spark.createDataFrame(table)
    out = rn.discount_waterfall(df, ["g"], "value", "discount", "flag", "i", num_ranges=7, hot_threshold=threshold)
    got = defaultdict(dict)
    for r in out.collect():
        got[r.g][r.i] = r.discounted_value
    assert {g: [v[i] for i in range(len(v))] for g, v in got.items()} == {g: [c / 100 for c in v] for g, v in want.items()}


def test_waterfall_keeps_cents(spark):
    df = spark.createDataFrame([(1, i, 0.1, False, 0.2) for i in range(3)] + [(2, 0, 100.1, False, 100.0)],
                               "g int, i int, value double, flag boolean, discount double")
    out = rn.discount_waterfall(df, ["g"], "value", "discount", "flag", "i").collect()
    assert sorted((r.g, r.i, r.discounted_value) for r in out) == [(1, 0, 0.0), (1, 1, 0.0), (1, 2, 0.1), (2, 0, 0.1)]


def best(options):
    valid = [o for o in options if o[1] and o[1] > 0 and o[2] is not None and o[2] >= 0]
    if not valid:
        return None
    d, p = min(o[1] for o in valid), min(o[2] for o in valid)
    both = [o for o in valid if o[1] == d and o[2] == p]
    if both:
        return min(both)[:1] + (True,)
    return min((o[1] / d + o[2] / (p or 1), o[0]) for o in valid)[1:] + (False,)


def test_best_option_with_a_hot_quote(spark):
    rng = random.Random(5)
    options = defaultdict(list)
    for i in range(6000):
        q = 0 if i % 3 == 0 else rng.randint(1, 300)
        options[q].append((len(options[q]), rng.choice([None, 0, 1, 2, 3, 5, 8, 13]), rng.choice([None, -1.0, 0.0, 1.5, 2.25, 9.0, 30.0])))
    df = spark.createDataFrame([(q, *o) for q, v in options.items() for o in v],
                               "freight_quote_id long, line_index int, carrier_deadline int, price double")
    out = fr.best_option_score(df)
    got = {r.freight_quote_id: (r.line_index, r.by_dominance) for r in out.collect()}
    assert got == {q: best(v) for q, v in options.items() if best(v)}
    plan = fr.best_option_score(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(freight_quote_id#" in plan and ", cd#" in plan      # dealt by (quote, deadline) first
    reduced = [line for line in plan.splitlines() if "partial_min(struct(p" in line]
    assert reduced and all("cd#" in line for line in reduced)                       # combined before the shuffle


def test_sku_conflicts_with_a_hot_sku(spark):
    rng = random.Random(6)
    rows = [("hot" if i % 3 == 0 else f"s{rng.randint(1, 200)}", rng.randint(1, 4), i) for i in range(5000)]
    rows += [(None, 1, 5000), ("single", 9, 5001), ("single", 9, 5002)]
    df = spark.createDataFrame(rows, "sku string, ext int, at int")
    owner, last = {}, {}
    for sku, ext, at in sorted((r for r in rows if r[0]), key=lambda r: r[2]):
        owner.setdefault(sku, ext)
        if owner[sku] == ext:
            last[sku] = (sku, ext, at)
    kept, conflicts = dd.sku_conflicts(df, "sku", "ext", ["at"])
    assert Counter(map(tuple, kept.collect())) == Counter(last.values())
    assert Counter(map(tuple, conflicts.collect())) == Counter(r for r in rows if r[0] and owner[r[0]] != r[1])
