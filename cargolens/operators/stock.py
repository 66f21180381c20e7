"""Carrier → logistics operator matching (J13) and the stock ledger
(A7, I13, I14).

J13 is a similarity join. It is evaluated without a cross join: candidate
(carrier, term) pairs come from exact equi-joins whose keys are derived from
the strings, then every candidate is checked with the exact rule. The
blocking is complete (no match is missed), and a string has a number of keys
that is constant or linear in its length:

* equality — the normalised strings themselves;
* containment (shorter side ≥ 8 chars) — the shorter string's *rarest* 8-gram
  over all strings of both sides must be among the longer one's 8-grams;
* edit distance ≤ 2, both texts of 13 characters or more — an edit changes at
  most three 3-grams, so the smallest common 3-gram, in order of rarity, is
  among the seven rarest of either text;
* edit distance ≤ d (1 or 2), short texts (up to 12 characters, and 13 or 14
  against those) — two texts within d edits have a text in common that
  either gives by leaving out at most d characters; the keys are these texts
  (at most 106 a text), so only texts that are nearly alike meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.session import write_once

MIN_CONTAIN = 8
SHORT = 12              # texts up to this length meet on what is left of them without some characters
PREFIX = 7              # rarest 3-grams of a longer text: two edits change at most six


def norm_text(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def _grams(s: Column, size: int = MIN_CONTAIN) -> Column:
    """The distinct substrings of ``size`` characters (none of a shorter text)."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(s) - size + 1, F.lit(1)))
    return F.when(F.length(s) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(s, i, size)))).otherwise(
        F.array().cast("array<string>"))


def _without(s: Column, i: Column) -> Column:
    """``s`` without its ``i``-th character (1-based)."""
    return F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, F.length(s)))


def _probe_keys(s: Column) -> Column:
    """Hashed keys under which a text finds those within its allowed edits:
    itself and what is left without one or two characters. One edit is allowed
    where the longer text has at most 7 characters, two from 8 on; the two have
    keys apart, and a text of 6 (7) meets longer ones with none (one) left out."""
    n = F.length(s)
    none = F.array().cast("array<string>")
    places = lambda first: F.sequence(F.lit(first), n)
    one = F.when(n >= 4, F.transform(places(1), lambda i: _without(s, i))).otherwise(none)
    two = F.when(n >= 8, F.flatten(F.transform(places(2), lambda j: F.transform(
        F.sequence(F.lit(1), j - 1), lambda i: _without(_without(s, j), i))))).otherwise(none)
    keys = lambda edits, *texts: F.transform(F.concat(F.array(s), *texts), lambda x: F.xxhash64(F.lit(edits), x))
    return F.array_distinct(F.when(n < 3, F.array().cast("array<bigint>")).when(n <= 5, keys(1, one)).when(n == 6, F.concat(keys(1, one), keys(2)))
                            .when(n == 7, F.concat(keys(1, one), keys(2, one))).when(n <= SHORT + 2, keys(2, one, two))
                            .otherwise(F.array().cast("array<bigint>")))


_segment_keys = _probe_keys     # both sides have the same keys


def carrier_matches(a: Column, b: Column) -> Column:
    """The exact match rule between two normalised strings."""
    la, lb = F.length(a), F.length(b)
    mn, mx = F.least(la, lb), F.greatest(la, lb)
    contain = (mn >= MIN_CONTAIN) & ((F.instr(a, b) > 0) | (F.instr(b, a) > 0))
    d = F.levenshtein(a, b, 2)
    near = (mx >= 4) & (d >= 0) & (F.when(mx <= 7, d <= 1).otherwise(d <= 2))
    return (a != "") & (b != "") & ((a == b) | contain | near)


def _dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is dealt out by key, never broadcast. The
    planner takes a text and the dozens of rows it is exploded to for the same
    size, so by its guess the driver would gather tables of hundreds of MB."""
    return df.hint("merge")


def candidate_pairs(carriers: DataFrame, terms: DataFrame) -> DataFrame:
    """``carriers(c)`` × ``terms(t)`` pairs that may match (a superset of the
    matches, no cross join). Names that share common words meet only if the
    rarest 8-gram of one is in the other or they are nearly alike."""
    def keyed(keys: Column, equal: Column) -> Column:
        return F.explode(F.concat(keys, F.array(F.xxhash64(F.lit("="), equal)))).alias("key")

    near = (carriers.select("c", keyed(_probe_keys(F.col("c")), F.col("c")))
            .join(_dealt(terms.select("t", keyed(_segment_keys(F.col("t")), F.col("t")))), "key").select("c", "t"))

    def grams(size: int, least: int) -> tuple[DataFrame, DataFrame]:
        """(c, g, n) and (t, g, n): grams of the texts of ``least`` characters
        or more, with the number of texts that hold them."""
        sides = [df.where(F.length(s) >= least).select(s, F.explode(_grams(F.col(s), size)).alias("g")) for df, s in ((carriers, "c"), (terms, "t"))]
        counts = sides[0].select("g").union(sides[1].select("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        return tuple(side.join(_dealt(counts), "g") for side in sides)

    def rarest(side: DataFrame, name: str, k: int) -> DataFrame:
        """The ``k`` rarest grams of each text (a text has few, and they are its own)."""
        ordered = side.groupBy(name).agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "g"))), 1, k).alias("r"))
        return ordered.select(name, F.explode("r.g").alias("g"))

    cg, tg = grams(MIN_CONTAIN, MIN_CONTAIN)
    held = rarest(cg, "c", 1).join(_dealt(tg), "g").select("c", "t").union(rarest(tg, "t", 1).join(_dealt(cg), "g").select("c", "t"))
    c3, t3 = grams(3, SHORT + 1)
    like = rarest(c3, "c", PREFIX).join(_dealt(rarest(t3, "t", PREFIX)), "g").where(F.abs(F.length("c") - F.length("t")) <= 2).select("c", "t")
    return near.union(held).union(like).distinct()


def operator_terms(operators: DataFrame, id_col: str = "operator_id", company_col: str = "company_id",
                   synonyms_col: str = "synonyms", slug_col: str = "slug", name_col: str = "company_name") -> DataFrame:
    """Terms of every operator: synonyms, slug and company name, trimmed,
    non-empty, normalised; ``operator_id, company_id, t``."""
    raw = F.concat(F.coalesce(F.col(synonyms_col), F.array().cast("array<string>")),
                   F.array(F.col(slug_col).cast("string"), F.col(name_col).cast("string")))
    ex = operators.select(id_col, company_col, F.explode(raw).alias("_t"))
    return ex.select(id_col, company_col, norm_text(F.col("_t")).alias("t")) \
        .where(F.col("t").isNotNull() & (F.col("t") != "")).distinct()


def _dealt_texts(df: DataFrame, name: str) -> DataFrame:
    """The distinct texts of a one-column table, written once and dealt over all
    tasks: the blocking reads them many times, and a text of few bytes makes
    dozens of keys, so tasks cut by bytes would be few and long."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_once(df.repartition(n, *df.columns).distinct(), name)


def match_operators(carriers: DataFrame, operators: DataFrame, stock: DataFrame | None = None,
                    carrier_col: str = "carrier", origin_col: str = "origin_id") -> DataFrame:
    """The first operator (lowest id) with a term matching each
    (carrier, origin). When the origin has stock rows, only operators whose
    company holds stock for that origin qualify.

    ``carriers``: ``carrier, origin_id``; ``operators``: ``operator_id,
    company_id, company_name, slug, synonyms``; ``stock``: ``origin_id,
    logistic_company_id``. Output: ``carrier_norm, origin_id, operator_id,
    company_id, company_name``.
    """
    pairs_in = write_once(carriers.select(norm_text(F.col(carrier_col)).alias("carrier_norm"), F.col(origin_col).alias("origin_id"))
                          .where(F.col("carrier_norm") != "").distinct(), "carrier-origins")
    distinct_c = _dealt_texts(pairs_in.select(F.col("carrier_norm").alias("c")), "carrier-texts")
    terms = write_once(operator_terms(operators), "operator-terms")
    distinct_t = _dealt_texts(terms.select("t"), "operator-texts")
    cand = candidate_pairs(distinct_c, distinct_t).where(carrier_matches(F.col("c"), F.col("t")))
    hits = write_once(cand.join(_dealt(terms), "t").select(F.col("c").alias("carrier_norm"), "operator_id", "company_id").distinct(), "operator-hits")
    m = pairs_in.join(_dealt(hits), "carrier_norm")
    if stock is not None:
        allowed = stock.select("origin_id", F.col("logistic_company_id").alias("company_id")).distinct() \
            .withColumn("_allowed", F.lit(True))
        has_stock = stock.select("origin_id").distinct().withColumn("_has_stock", F.lit(True))
        m = m.join(allowed, ["origin_id", "company_id"], "left").join(has_stock, "origin_id", "left")
        m = m.where(F.col("_has_stock").isNull() | F.col("_allowed").isNotNull())
    best = m.groupBy("carrier_norm", "origin_id").agg(F.min(F.struct("operator_id", "company_id")).alias("b"))
    names = operators.select("operator_id", "company_name")
    return best.select("carrier_norm", "origin_id", F.col("b.operator_id").alias("operator_id"),
                       F.col("b.company_id").alias("company_id")).join(names, "operator_id", "left")


def quantity_by_product(items: DataFrame, order_col: str = "order_id", product_col: str = "product_id",
                        qty_col: str = "quantity") -> DataFrame:
    """Σ max(0, floor(qty)) per (order, product); null products and
    non-positive quantities are skipped."""
    q = F.greatest(F.lit(0), F.floor(F.col(qty_col).cast("double"))).cast("bigint")
    return (items.where(F.col(product_col).isNotNull()).withColumn("_q", q).where(F.col("_q") > 0)
            .groupBy(order_col, product_col).agg(F.sum("_q").alias("quantity")))


def apply_order_stock(orders: DataFrame, items: DataFrame, stock: DataFrame, ledger: DataFrame,
                      operators: DataFrame) -> dict[str, DataFrame]:
    """For every non-cancelled order with a carrier, resolve its operator
    (J13), then per product one movement of −quantity against the stock row
    (origin, operator company, product) unless that order already moved that
    stock. Stock without a row for the product is reported as missing.

    ``orders``: ``order_id, origin_id, carrier, status``; ``items``:
    ``order_id, product_id, quantity``; ``stock``: ``stock_id, origin_id,
    logistic_company_id, product_id, quantity``; ``ledger``: ``stock_id,
    quantity, type, type_id``.
    Returns ``stock``, ``ledger``, ``new_movements``, ``missing``, ``orders``
    (carrier replaced by the operator's company name).
    """
    live = orders.where((F.col("status") != "cancelado") & (F.trim(F.coalesce(F.col("carrier"), F.lit(""))) != ""))
    ops = match_operators(live.select("carrier", "origin_id"), operators, stock)
    resolved = live.withColumn("carrier_norm", norm_text(F.col("carrier"))) \
        .join(ops, ["carrier_norm", "origin_id"], "inner") \
        .select("order_id", "origin_id", F.col("company_id").alias("logistic_company_id"), "company_name")
    qty = quantity_by_product(items).join(resolved, "order_id")
    st = stock.select("stock_id", "origin_id", "logistic_company_id", "product_id")
    with_stock = qty.join(st, ["origin_id", "logistic_company_id", "product_id"], "left")
    missing = with_stock.where(F.col("stock_id").isNull()).select("order_id", "product_id", "logistic_company_id")
    done = ledger.where(F.col("type") == "order").select("stock_id", F.col("type_id").alias("_tid")).distinct()
    cand = with_stock.where(F.col("stock_id").isNotNull()) \
        .withColumn("_tid", F.col("order_id").cast("string"))
    new = cand.join(done, ["stock_id", "_tid"], "left_anti").select(
        "stock_id", (-F.col("quantity")).alias("quantity"), F.lit("order").alias("type"), F.col("_tid").alias("type_id"))
    delta = new.groupBy("stock_id").agg(F.sum("quantity").alias("_d"))
    stock2 = stock.join(delta, "stock_id", "left") \
        .withColumn("quantity", F.col("quantity") + F.coalesce(F.col("_d"), F.lit(0))).drop("_d")
    ledger2 = ledger.unionByName(new.select(*ledger.columns))
    orders2 = orders.join(resolved.select("order_id", "company_name"), "order_id", "left") \
        .withColumn("carrier", F.coalesce(F.col("company_name"), F.col("carrier"))).drop("company_name")
    return {"stock": stock2, "ledger": ledger2, "new_movements": new, "missing": missing, "orders": orders2}


def reverse_cancelled(orders: DataFrame, stock: DataFrame, ledger: DataFrame) -> dict[str, DataFrame]:
    """A cancelled order gives back Σ |quantity| of its 'order'
    movements to each stock row, and those movements are removed.
    Running it again changes nothing."""
    cancelled = orders.where(F.col("status") == "cancelado").select(F.col("order_id").cast("string").alias("type_id"))
    movs = ledger.where(F.col("type") == "order").join(cancelled, "type_id", "left_semi")
    back = movs.groupBy("stock_id").agg(F.sum(F.abs("quantity")).alias("_b"))
    stock2 = stock.join(back, "stock_id", "left") \
        .withColumn("quantity", F.col("quantity") + F.coalesce(F.col("_b"), F.lit(0))).drop("_b")
    is_cancelled_mov = (F.col("type") == "order")
    keep = ledger.join(cancelled.withColumn("_c", F.lit(True)), "type_id", "left")
    ledger2 = keep.where(~(is_cancelled_mov & F.col("_c").isNotNull())).drop("_c").select(*ledger.columns)
    return {"stock": stock2, "ledger": ledger2}


def net_movements(events: DataFrame, stock: DataFrame, ledger: DataFrame, items: DataFrame, operators: DataFrame) -> dict[str, DataFrame]:
    """I13/I14 over several states of an order in one run. ``events``: ``seq,
    order_id, origin_id, carrier, status``, ``items``: ``seq, order_id,
    product_id, quantity`` (the lines an event came with).

    Going through an order's events in turn, a cancellation gives its stock
    back and a live state moves it unless it is moved already. So only two
    things matter per (order, stock): whether the run cancels the order at
    all (then its stored movements go), and the live states after its last
    cancellation, the first of which to reach that stock moves it. Both are
    aggregates over the events; no order is gathered.
    """
    last = events.where(F.col("status") == "cancelado").groupBy("order_id").agg(F.max("seq").alias("_cut"))
    given_back = reverse_cancelled(last.select("order_id", F.lit("cancelado").alias("status")), stock, ledger)
    live = (events.where(F.col("status") != "cancelado").join(last, "order_id", "left")
            .where(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut"))).drop("_cut"))
    each = lambda df: df.withColumn("_event", F.to_json(F.struct(F.col("order_id").alias("o"), F.col("seq").alias("s"))))
    tried = apply_order_stock(
        each(live).withColumnRenamed("order_id", "_order").withColumnRenamed("_event", "order_id"),
        each(items).drop("order_id").withColumnRenamed("_event", "order_id"), given_back["stock"], ledger.limit(0), operators)["new_movements"]
    parsed = tried.select("stock_id", "quantity", "type", F.get_json_object("type_id", "$.o").alias("type_id"),
                          F.get_json_object("type_id", "$.s").cast("long").alias("seq"))
    first = parsed.groupBy("stock_id", "type", "type_id").agg(F.min_by("quantity", "seq").alias("quantity"))
    done = given_back["ledger"].where(F.col("type") == "order").select("stock_id", "type_id").distinct()
    new = first.join(done, ["stock_id", "type_id"], "left_anti").select(*ledger.columns)
    delta = new.groupBy("stock_id").agg(F.sum("quantity").alias("_d"))
    stock2 = (given_back["stock"].join(delta, "stock_id", "left")
              .withColumn("quantity", F.col("quantity") + F.coalesce(F.col("_d"), F.lit(0))).drop("_d"))
    return {"stock": stock2, "ledger": given_back["ledger"].unionByName(new), "new_movements": new}
