"""Payload ingest queries.

Landed partner documents are built from single table rows with
``to_json(struct(...))`` (one document per order / part / customer — no
grouping), then read back through the payload path: repair (S3), parse
and expand (S2), flatten (P13–P17). The oracles compute the expected flat
rows directly from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.functions.dates import parse_timestamp
from cargolens.functions.text import brazilian_state, join_non_blank
from cargolens.operators import flatten as fl
from cargolens.plans.registry import query
from cargolens.sources import payload as pl
from cargolens.sources.tables import Tables

TS = "yyyy-MM-dd HH:mm:ss"


def _anymarket_doc(o_suffix=None):
    """An AnyMarket-shaped order document from an orders row."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    oid = k.cast("string") if o_suffix is None else F.concat(k.cast("string"), F.lit(o_suffix))
    status = F.element_at(F.array(*[F.lit(s) for s in ("CONCLUDED", "PAID_WAITING_SHIP", "CANCELED", "PENDING")]),
                          (k % 4 + 1).cast("int"))
    doc = F.lpad(c.cast("string"), 11, "0")
    document = F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(
        F.substring(doc, 1, 3), F.lit("."), F.substring(doc, 4, 3), F.lit("."), F.substring(doc, 7, 3), F.lit("-"),
        F.substring(doc, 10, 2)))
    state = F.element_at(F.array(F.lit("sp"), F.lit("RJ"), F.lit(" mg ")), (c % 3 + 1).cast("int"))
    shipping = F.struct(state.alias("state"), F.concat(F.lit("Cidade "), (c % 50).cast("string")).alias("city"),
                        F.when(k % 2 == 0, F.concat(F.lit("Apto "), (k % 100).cast("string"))).otherwise(F.lit(" "))
                        .alias("comment"),
                        F.when(k % 3 == 0, F.lit("Perto da praça")).alias("reference"))
    tracking = F.when(k % 3 != 0, F.struct(F.concat(F.lit("Transp "), (c % 5).cast("string")).alias("carrier"),
                                           F.lit("Normal").alias("deliveryMethodName")))
    item1 = F.struct((k % 3 + 1).alias("amount"),
                     F.when(k % 5 == 0, F.lit(None)).otherwise(F.floor(F.col("o_totalprice") * 10) / 100).alias("sellPrice"),
                     (F.col("o_totalprice") / 5).alias("total"),
                     F.struct(c.alias("id"), F.lpad(c.cast("string"), 13, "7").alias("ean"),
                              F.concat(F.lit("Produto "), c.cast("string")).alias("title"),
                              F.lit(None).cast("string").alias("partnerId")).alias("sku"),
                     F.array(F.struct(F.when(k % 2 == 0, F.lit("UNKNOWN")).otherwise(F.lit("Correios"))
                                      .alias("shippingCarrierNormalized"), F.lit("PAC").alias("shippingtype")))
                     .alias("shippings"))
    item2 = F.struct(F.lit(1).alias("amount"), F.lit(None).cast("double").alias("sellPrice"), F.lit(9.9).alias("total"),
                     F.struct(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("ean"),
                              F.lit(None).cast("string").alias("title"),
                              F.concat(F.lit("45145["), k.cast("string"), F.lit("]")).alias("partnerId")).alias("sku"),
                     F.array().cast("array<struct<shippingCarrierNormalized:string,shippingtype:string>>").alias("shippings"))
    buyer = F.struct(F.concat(F.lit("Cliente "), c.cast("string")).alias("name"), document.alias("document"),
                     F.concat(F.lit("c"), c.cast("string"), F.lit("@x.com")).alias("email"))
    return F.to_json(F.struct(
        oid.alias("id"), status.alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-03:00'").alias("createdAt"),
        F.col("o_totalprice").alias("total"), buyer.alias("buyer"), shipping.alias("shipping"),
        tracking.alias("tracking"), F.array(item1.cast(item1_type()), item2.cast(item1_type())).alias("items")))


def item1_type():
    return ("struct<amount:bigint,sellPrice:double,total:double,sku:struct<id:bigint,ean:string,title:string,"
            "partnerId:string>,shippings:array<struct<shippingCarrierNormalized:string,shippingtype:string>>>")


def _landed_orders(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", _anymarket_doc().alias("text"))


def _objects(spark, sf_dir):
    return pl.expand_objects(pl.parse_payloads(_landed_orders(spark, sf_dir)))


_STATUS_SQL = "(case o_orderkey % 4 when 0 then 'CONCLUDED' when 1 then 'PAID_WAITING_SHIP' when 2 then 'CANCELED' else 'PENDING' end)"


@query("s02_landed_payload_read", oracle="""
select o_orderkey, 0 as obj_pos, cast(o_orderkey as varchar) as external_id from orders
union all select o_orderkey, 1, cast(o_orderkey as varchar) || '-b' from orders where o_orderkey % 4 = 0
""")
def s02_landed_payload_read(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    page = F.when(o["o_orderkey"] % 4 == 0, F.concat(F.lit("["), _anymarket_doc(), F.lit(","),
                                                     _anymarket_doc("-b"), F.lit("]"))).otherwise(_anymarket_doc())
    ex = pl.expand_objects(pl.parse_payloads(o.select("o_orderkey", page.alias("text"))))
    return ex.select("o_orderkey", "obj_pos", pl.pick_string(F.col("obj"), "$.id").alias("external_id"))


@query("s03_dirty_json_repair", oracle=f"""
select o_orderkey, case when o_orderkey % 11 = 0 then null else o_orderkey end as id,
  case when o_orderkey % 11 = 0 then null else o_orderkey % 2 = 0 end as flag,
  case when o_orderkey % 11 = 0 then null else floor(o_totalprice) + 0.25 end as total,
  cast(case when o_orderkey % 11 = 0 then null else 5 end as bigint) as qty,
  cast(case when o_orderkey % 11 = 0 then null else 1.5 end as double) as dec,
  case when o_orderkey % 11 = 0 then null else o_custkey end as k,
  o_orderkey % 11 = 0 as quarantined
from orders
""")
def s03_dirty_json_repair(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k = F.col("o_orderkey")
    body = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "flag": '),
                    F.when(k % 2 == 0, F.lit("True")).otherwise(F.lit("False")),
                    F.lit(', "none": None, "total": float( '), F.floor("o_totalprice").cast("bigint").cast("string"),
                    F.lit('.25 ), "qty": int(5), "dec": Decimal(1.50), "k": count__int('),
                    F.col("o_custkey").cast("string"), F.lit(")}"))
    prefix = F.when(k % 3 == 0, F.lit("\ufefftotal__int( 3 )\n")).otherwise(F.lit("x "))
    text = F.when(k % 11 == 0, F.lit("garbage {not json")).otherwise(F.concat(prefix, body))
    parsed = pl.parse_payloads(o.select("o_orderkey", text.alias("text")), repair=True)
    p = F.col("payload")
    return parsed.select("o_orderkey", F.try_variant_get(p, "$.id", "bigint").alias("id"),
                         F.try_variant_get(p, "$.flag", "boolean").alias("flag"),
                         pl.pick_number(p, "$.total").alias("total"), F.try_variant_get(p, "$.qty", "bigint").alias("qty"),
                         pl.pick_number(p, "$.dec").alias("dec"), F.try_variant_get(p, "$.k", "bigint").alias("k"),
                         p.isNull().alias("quarantined"))


@query("p13_flatten_orders", oracle=f"""
select cast(o_orderkey as varchar) as external_id, {_STATUS_SQL} as status_raw,
  strftime(o_orderdate + interval 3 hour, '%Y-%m-%d %H:%M:%S') as created_at, o_totalprice as total,
  upper(trim(case o_custkey % 3 when 0 then 'sp' when 1 then 'RJ' else ' mg ' end)) as delivery_state,
  'Cidade ' || cast(o_custkey % 50 as varchar) as delivery_city,
  nullif(concat_ws(' · ', case when o_orderkey % 2 = 0 then 'Apto ' || cast(o_orderkey % 100 as varchar) end,
                   case when o_orderkey % 3 = 0 then 'Perto da praça' end), '') as delivery_complement
from orders
""")
def p13_flatten_orders(spark, sf_dir):
    objs = _objects(spark, sf_dir)
    flat = fl.flatten_orders(objs, "anymarket", keep=("obj",))
    return flat.select("external_id", "status_raw", F.date_format("created_at", TS).alias("created_at"), "total",
                       brazilian_state(F.col("delivery_state")).alias("delivery_state"), "delivery_city",
                       fl.delivery_complement(F.col("obj")).alias("delivery_complement"))


@query("n32_carrier_cascade", oracle="""
select cast(o_orderkey as varchar) as external_id,
  case when o_orderkey % 3 <> 0 then 'Transp ' || cast(o_custkey % 5 as varchar)
       when o_orderkey % 2 = 0 then 'PAC' else 'Correios' end as carrier,
  case when o_orderkey % 3 <> 0 then 'Normal' end as subsidiary
from orders
""")
def n32_carrier_cascade(spark, sf_dir):
    objs = _objects(spark, sf_dir)
    carrier, sub = fl.anymarket_carrier(F.col("obj"))
    return objs.select(pl.pick_string(F.col("obj"), "$.id").alias("external_id"), carrier.alias("carrier"),
                       sub.alias("subsidiary"))


@query("p14_flatten_customers", oracle="""
select cast(o_orderkey as varchar) as order_id, 'Cliente ' || cast(o_custkey as varchar) as name,
  'c' || cast(o_custkey as varchar) || '@x.com' as email,
  case when o_orderkey % 10 = 0 then 'AM-' || cast(o_orderkey as varchar) else lpad(cast(o_custkey as varchar), 11, '0') end as tax_id
from orders
""")
def p14_flatten_customers(spark, sf_dir):
    objs = _objects(spark, sf_dir).withColumn("order_id", pl.pick_string(F.col("obj"), "$.id"))
    cust = fl.flatten_customers(objs, "anymarket", keep=("order_id",), synthetic_prefix="AM-")
    return cust.select("order_id", "name", "email", "tax_id")


@query("p16_flatten_order_items", oracle="""
select cast(o_orderkey as varchar) as order_id, 0 as item_index, cast(o_custkey as varchar) as sku_id,
  lpad(cast(o_custkey as varchar), 13, '7') as ean, cast(o_orderkey % 3 + 1 as double) as quantity,
  case when o_orderkey % 5 = 0 then (o_totalprice / 5) / (o_orderkey % 3 + 1) else floor(o_totalprice * 10) / 100 end as unit_price,
  cast(null as varchar) as store_reference, cast(null as varchar) as external_reference
from orders
union all
select cast(o_orderkey as varchar), 1, '45145[' || cast(o_orderkey as varchar) || ']', null, 1.0, 9.9, '45145', cast(o_orderkey as varchar)
from orders
""")
def p16_flatten_order_items(spark, sf_dir):
    objs = _objects(spark, sf_dir).withColumn("order_id", pl.pick_string(F.col("obj"), "$.id"))
    items = fl.order_items(objs, "obj", "$.items", keep=("order_id",))
    f = fl.anymarket_item_fields(F.col("item"))
    return items.select("order_id", "item_index", *[f[c].alias(c) for c in
                                                     ("sku_id", "ean", "quantity", "unit_price", "store_reference",
                                                      "external_reference")])


def _product_doc():
    k = F.col("p_partkey")
    t = "struct<url:string,standardUrl:string,thumbnailUrl:string,main:boolean,index:int>"

    def im(url=None, std=None, thumb=None, main=None, index=None):
        return F.struct(F.lit(url).cast("string").alias("url"), F.lit(std).cast("string").alias("standardUrl"),
                        F.lit(thumb).cast("string").alias("thumbnailUrl"), F.lit(main).cast("boolean").alias("main"),
                        F.lit(index).cast("int").alias("index"))
    images = (F.when(k % 4 == 0, F.array(im(url="http://img/a.jpg", main=False), im(url="http://img/main.jpg", main=True)))
              .when(k % 4 == 1, F.array(im(url="ftp://no", index=2), im(std="https://img/std.jpg", index=1)))
              .when(k % 4 == 2, F.array(im(url="notvalid"), im(thumb="http://img/t.jpg")))
              .otherwise(F.array().cast(f"array<{t}>")))
    s1 = F.struct(F.concat(F.lit("S"), k.cast("string"), F.lit("-1")).alias("id"),
                  F.lpad(k.cast("string"), 13, "7").alias("ean"), F.lit(None).cast("string").alias("title"),
                  F.col("p_retailprice").alias("price"),
                  F.concat(k.cast("string"), F.lit("["), F.col("p_size").cast("string"), F.lit("]")).alias("partnerId"))
    s2 = F.struct(F.concat(F.lit("S"), k.cast("string"), F.lit("-2")).alias("id"), F.lit(None).cast("string").alias("ean"),
                  F.col("p_brand").alias("title"), F.lit(None).cast("double").alias("price"), F.lit("x").alias("partnerId"))
    return F.to_json(F.struct(k.alias("id"), F.col("p_name").alias("title"), images.alias("images"),
                              F.array(s1, s2).alias("skus")))


@query("p15_flatten_products", oracle="""
select cast(p_partkey as varchar) as product_external_id, 0 as sku_index, 'S' || cast(p_partkey as varchar) || '-1' as sku,
  lpad(cast(p_partkey as varchar), 13, '7') as ean, p_name as name, p_retailprice as price,
  cast(p_partkey as varchar) as store_reference, cast(p_size as varchar) as external_reference
from part
union all
select cast(p_partkey as varchar), 1, 'S' || cast(p_partkey as varchar) || '-2', null, p_brand, null, 'x', null from part
""")
def p15_flatten_products(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    objs = pl.expand_objects(pl.parse_payloads(p.select(_product_doc().alias("text"))))
    rows = fl.product_skus(objs)
    return rows.select("product_external_id", "sku_index", "sku", "ean", "name", "price", "store_reference",
                       "external_reference")


@query("n37_main_image", oracle="""
select cast(p_partkey as varchar) as product_external_id,
  case p_partkey % 4 when 0 then 'http://img/main.jpg' when 1 then 'https://img/std.jpg' when 2 then 'http://img/t.jpg' end as photo
from part
""")
def n37_main_image(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    objs = pl.expand_objects(pl.parse_payloads(p.select(_product_doc().alias("text"))))
    v = F.col("obj")
    return objs.select(pl.pick_string(v, "$.id").alias("product_external_id"),
                         fl.main_image(pl.pick_array(v, "$.images")).alias("photo"))


def _quote_doc():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    produto = F.array(
        F.struct(F.concat(c.cast("string"), F.lit("-"), (k % 7).cast("string")).alias("sku"), c.alias("idSku"),
                 F.lit(1).alias("qt"), (F.floor("o_totalprice") / 10).alias("preco")),
        F.struct(F.lit(None).cast("string").alias("sku"), F.lit(77).cast("bigint").alias("idSku"),
                 F.lit(2).alias("qt"), F.lit(None).cast("double").alias("preco")))
    opcoes = F.array(
        F.struct((F.floor("o_totalprice") / 100).alias("freteCobrar"), (F.floor("o_totalprice") / 200).alias("freteReal"),
                 (k % 20 + 1).alias("prazoEntregaTotal"),
                 F.struct(F.concat(F.lit("T"), (c % 4).cast("string")).alias("transportadoraNome")).alias("dadosFrete"),
                 F.struct((k % 9).alias("prazoTransportadora")).alias("prazoEntrega")),
        F.struct(F.lit(0.0).alias("freteCobrar"), F.lit(None).cast("double").alias("freteReal"),
                 F.lit(30).cast("bigint").alias("prazoEntregaTotal"),
                 F.struct(F.lit("Retira").alias("transportadoraNome")).alias("dadosFrete"),
                 F.struct(F.lit(None).cast("bigint").alias("prazoTransportadora")).alias("prazoEntrega")))
    retorno = F.struct(F.concat(F.lit("Q"), k.cast("string")).alias("idCotacao"), F.lit("allpost").alias("plataforma"),
                       F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dataCotacao"),
                       F.struct(F.element_at(F.array(F.lit("SP"), F.lit("RJ")), (c % 2 + 1).cast("int")).alias("uf"))
                       .alias("destino"))
    entrada = F.struct(F.col("o_orderpriority").alias("canal"),
                       F.struct(F.col("o_totalprice").alias("valorNF"), produto.alias("produto")).alias("carrinho"))
    return F.to_json(F.struct(retorno.alias("retorno"), entrada.alias("dadosEntrada"), opcoes.alias("opcoesEntrega")))


def _quote_rows(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return fl.freight_quote_rows(pl.expand_objects(pl.parse_payloads(o.select(_quote_doc().alias("text")))))


@query("p17_flatten_freight_quotes", oracle="""
select 'Q' || cast(o_orderkey as varchar) as quote_id, 'allpost' as platform,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as quoted_at, case when o_custkey % 2 = 0 then 'SP' else 'RJ' end as destination_state,
  o_orderpriority as channel, o_totalprice as invoice_value
from orders
""")
def p17_flatten_freight_quotes(spark, sf_dir):
    q = _quote_rows(spark, sf_dir)["quotes"]
    return q.withColumn("quoted_at", F.date_format("quoted_at", TS))


@query("p17_quote_options", oracle="""
select 'Q' || cast(o_orderkey as varchar) as quote_id, 0 as line_index, floor(o_totalprice) / 100 as shipping_value,
  floor(o_totalprice) / 200 as real_value, cast(o_orderkey % 20 + 1 as integer) as deadline,
  cast(o_orderkey % 9 as integer) as carrier_deadline, 'T' || cast(o_custkey % 4 as varchar) as carrier from orders
union all
select 'Q' || cast(o_orderkey as varchar), 1, 0.0, null, 30, null, 'Retira' from orders
""")
def p17_quote_options(spark, sf_dir):
    return _quote_rows(spark, sf_dir)["options"]


@query("p17_quote_items", oracle="""
select 'Q' || cast(o_orderkey as varchar) as quote_id, 0 as line_index,
  cast(o_custkey as varchar) || '-' || cast(o_orderkey % 7 as varchar) as partner_sku, cast(o_custkey as varchar) as id_sku,
  cast(1.0 as double) as quantity, floor(o_totalprice) / 10 as price from orders
union all
select 'Q' || cast(o_orderkey as varchar), 1, null, '77', cast(2.0 as double), null from orders
""")
def p17_quote_items(spark, sf_dir):
    return _quote_rows(spark, sf_dir)["items"]


def _freight_order_doc():
    k = F.col("o_orderkey")
    prod = lambda sku, n: F.struct(F.lit(sku).cast("string").alias("sku"),
                                   F.concat(F.lit("L"), k.cast("string"), F.lit(f"-{n}")).alias("skuLoja"),
                                   (k % 50 + n).alias("idSku"), F.lit(n).cast("bigint").alias("quantidade"),
                                   F.lit(None).cast("double").alias("preco"))
    e1 = F.struct(F.array(prod("A", 1), prod(None, 2)).alias("produtos"))
    e2 = F.struct(F.array(prod("B", 3)).alias("produtos"))
    envio = F.when(k % 2 == 0, F.array(e1, e2)).otherwise(F.array(e2))
    return F.to_json(F.struct(F.concat(F.lit("F"), k.cast("string")).alias("_id"), envio.alias("envio")))


@query("p17_freight_order_items", oracle="""
select 'F' || cast(o_orderkey as varchar) as freight_order_id, 0 as line_index, 0 as envio_index, 'A' as partner_sku,
  cast(o_orderkey % 50 + 1 as varchar) as id_sku, cast(1.0 as double) as quantity, cast(null as double) as price from orders where o_orderkey % 2 = 0
union all select 'F' || cast(o_orderkey as varchar), 1, 0, 'L' || cast(o_orderkey as varchar) || '-2',
  cast(o_orderkey % 50 + 2 as varchar), cast(2.0 as double), null from orders where o_orderkey % 2 = 0
union all select 'F' || cast(o_orderkey as varchar), case when o_orderkey % 2 = 0 then 2 else 0 end,
  case when o_orderkey % 2 = 0 then 1 else 0 end, 'B', cast(o_orderkey % 50 + 3 as varchar), cast(3.0 as double), null from orders
""")
def p17_freight_order_items(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return fl.freight_order_items(pl.expand_objects(pl.parse_payloads(o.select(_freight_order_doc().alias("text")))))


@query("n41_patient_and_contacts", oracle="""
select c_custkey, case when c_custkey % 3 = 0 then 'ICLINIC-P-' || cast(c_custkey as varchar) else 'P' || cast(c_custkey as varchar) end as tax_id,
  case when c_custkey % 2 = 0 then 'last' || cast(c_custkey as varchar) || '@x.com' else 'first' || cast(c_custkey as varchar) || '@x.com' end as email,
  case when c_custkey % 5 = 0 then null else '11-' || cast(c_custkey as varchar) end as phone
from customer
""")
def n41_patient_and_contacts(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    ct = lambda tipo, val: F.struct(F.lit(tipo).alias("tipo"), val.alias("contato"))
    contacts = F.array(ct(1, F.concat(F.lit("first"), k.cast("string"), F.lit("@x.com"))),
                       ct(2, F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("11-"), k.cast("string")))),
                       ct(1, F.lit("no-at-sign")),
                       ct(1, F.when(k % 2 == 0, F.concat(F.lit("last"), k.cast("string"), F.lit("@x.com")))))
    doc = F.to_json(F.struct(k.alias("id"), F.when(k % 3 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit("P"), k.cast("string"))).alias("code"), contacts.alias("contatos")))
    objs = pl.expand_objects(pl.parse_payloads(c.select("c_custkey", doc.alias("text"))))
    v = F.col("obj")
    cts = pl.pick_array(v, "$.contatos")
    return objs.select("c_custkey",
                         fl.patient_tax_id(F.coalesce(pl.pick_string(v, "$.code"), F.lit("")), pl.pick_string(v, "$.id"))
                         .alias("tax_id"),
                         fl.last_contact(cts, 1, "@").alias("email"), fl.last_contact(cts, 2).alias("phone"))


# --- a second partner shape (Precode) and the pickers (P18) -----------------------------

_PRECODE_STATUS = ["novo", "Analisando", " em viagem ", "ENTREGUE", "sumido"]


def _precode_doc():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    doc = F.lpad(c.cast("string"), 11, "0")
    cliente = F.struct(
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.substring(doc, 1, 3), F.lit("."), F.substring(doc, 4, 3),
                                                          F.lit("."), F.substring(doc, 7, 3), F.lit("-"),
                                                          F.substring(doc, 10, 2))).alias("cpfCnpj"),
        F.element_at(F.array(F.lit("F"), F.lit("j"), F.lit("PJ"), F.lit("x")), (c % 4 + 1).cast("int")).alias("tipo"),
        F.concat(F.lit("Cliente "), c.cast("string")).alias("nomeRazao"),
        F.element_at(F.array(F.lit("M"), F.lit("2"), F.lit("feminino"), F.lit("0")), (k % 4 + 1).cast("int")).alias("sexo"),
        F.struct(F.element_at(F.array(F.lit(" sp "), F.lit("RJ"), F.lit("XX")), (c % 3 + 1).cast("int")).alias("uf"),
                 F.concat(F.lit("Cidade "), (c % 9).cast("string")).alias("cidade")).alias("dadosEntrega"))
    rastreio = F.struct(F.when(k % 3 == 0, F.lit("Jadlog")).alias("transportadora"))
    return F.to_json(F.struct(
        k.cast("string").alias("codigoPedido"), F.concat(F.lit("PP-"), k.cast("string")).alias("pedidoParceiro"),
        F.element_at(F.array(*[F.lit(s) for s in _PRECODE_STATUS]), (k % 5 + 1).cast("int")).alias("statusAtual"),
        F.when(k % 2 == 0, (F.floor("o_totalprice") / 100).cast("string")).alias("valorFreteTxt"),
        F.when(k % 2 == 1, F.floor("o_totalprice") / 100).alias("valorFreteNum"),
        F.col("o_totalprice").alias("valorTotalCompra"), F.col("o_orderpriority").alias("canal"),
        cliente.alias("dadosCliente"), rastreio.alias("dadosRastreio"),
        F.when(k % 5 == 0, F.lit("Azul")).alias("transportadora"), F.lit("Total").alias("nomeTransportadora")))


def _precode_objects(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    # the partner sends valorFrete either as a number or as numeric text
    txt = F.regexp_replace(F.regexp_replace(_precode_doc(), '"valorFreteTxt"', '"valorFrete"'), '"valorFreteNum"',
                           '"valorFrete"')
    return pl.expand_objects(pl.parse_payloads(o.select(txt.alias("text"))))


_PRECODE_STATUS_SQL = "(case o_orderkey % 5 when 0 then 'novo' when 1 then 'em analise' when 2 then 'em transporte' when 3 then 'entregue' end)"


@query("p13_flatten_orders_precode", oracle=f"""
select cast(o_orderkey as varchar) as external_id, {_PRECODE_STATUS_SQL} as status,
  floor(o_totalprice) / 100 as freight, o_totalprice as total, o_orderpriority as channel,
  case o_custkey % 3 when 0 then 'SP' when 1 then 'RJ' end as delivery_state,
  case when o_orderkey % 3 = 0 then 'Jadlog' when o_orderkey % 5 = 0 then 'Azul' else 'Total' end as carrier
from orders
""")
def p13_flatten_orders_precode(spark, sf_dir):
    from cargolens.functions import status as S
    objs = _precode_objects(spark, sf_dir)
    flat = fl.flatten_orders(objs, "precode", keep=("obj",)).withColumn("platform", F.lit("precode"))
    mapped = S.map_status(flat, "platform", "status_raw", spark=spark, on_unmapped="null")
    return mapped.select("external_id", "status", "freight", "total", "channel",
                         brazilian_state(F.col("delivery_state")).alias("delivery_state"),
                         fl.precode_carrier(F.col("obj")).alias("carrier"))


@query("p14_flatten_customers_precode", oracle="""
select cast(o_orderkey as varchar) as order_id, 'Cliente ' || cast(o_custkey as varchar) as name,
  case when o_orderkey % 7 = 0 then 'PC-' || cast(o_orderkey as varchar) else lpad(cast(o_custkey as varchar), 11, '0') end as tax_id,
  case o_custkey % 4 when 0 then 'PF' when 1 then 'PJ' when 2 then 'PJ' end as person_type,
  case o_orderkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'F' end as gender
from orders
""")
def p14_flatten_customers_precode(spark, sf_dir):
    from cargolens.functions.parse import gender, person_type
    objs = _precode_objects(spark, sf_dir).withColumn("order_id", pl.pick_string(F.col("obj"), "$.codigoPedido"))
    cust = fl.flatten_customers(objs, "precode", keep=("order_id",), synthetic_prefix="PC-", id_path="$.codigoPedido")
    return cust.select("order_id", "name", "tax_id", person_type(F.col("person_type")).alias("person_type"),
                       gender(F.col("gender")).alias("gender"))


@query("p18_payload_pick", oracle="""
select cast(o_orderkey as varchar) as id,
  case when o_orderkey % 2 = 0 then 'Apto ' || cast(o_orderkey % 100 as varchar) end as comment,
  o_totalprice as total, cast(null as double) as missing_number, 2 as n_items, 0 as n_missing,
  o_orderkey % 3 <> 0 as has_tracking, cast(o_custkey as varchar) as sku_id_text
from orders
""")
def p18_payload_pick(spark, sf_dir):
    objs = _objects(spark, sf_dir)
    v = F.col("obj")
    return objs.select(pl.pick_string(v, "$.id").alias("id"), pl.pick_string(v, "$.shipping.comment").alias("comment"),
                       pl.pick_number(v, "$.total").alias("total"), pl.pick_number(v, "$.buyer.name").alias("missing_number"),
                       F.size(pl.pick_array(v, "$.items")).alias("n_items"),
                       F.size(pl.pick_array(v, "$.nothing")).alias("n_missing"),
                       pl.pick_object(v, "$.tracking").isNotNull().alias("has_tracking"),
                       pl.pick_string(v, "$.items[0].sku.id").alias("sku_id_text"))


# --- Tray (pages of Orders[].Order) and Panorama shapes ----------------------------------

def _tray_page():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    order = F.struct(
        k.cast("string").alias("id"), c.cast("string").alias("customer_id"),
        F.element_at(F.array(F.lit("ENVIADO"), F.lit("a enviar"), F.lit("Cancelado Aut")), (k % 3 + 1).cast("int"))
        .alias("status"),
        F.when(k % 9 == 0, F.lit("0000-00-00")).otherwise(day).alias("date"),
        F.element_at(F.array(F.lit("10:15:00"), F.lit("25:00:00"), F.lit("")), (k % 3 + 1).cast("int")).alias("hour"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.when(k % 2 == 0, F.concat(F.lit("Logística do vendedor - Transp "), (c % 4).cast("string"),
                                    F.lit(" - Normal - Origem: Cidade-"), (c % 7).cast("string")))
        .otherwise(F.lit("Retirada na loja")).alias("shipment"),
        F.when(k % 4 == 0, F.concat(F.lit("0000"), F.substring(day, 5, 6)))
        .otherwise(F.date_format(F.col("o_orderdate") + F.make_dt_interval(days=(k % 11).cast("int") - 3), "yyyy-MM-dd"))
        .alias("estimated_delivery_date"))
    return F.to_json(F.struct(F.array(F.struct(order.alias("Order"))).alias("Orders")))


@query("p13_flatten_orders_tray", oracle="""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day,
  case o_orderkey % 3 when 0 then '10:15:00' when 1 then '25:00:00' else '' end as hr from orders)
select cast(o_orderkey as varchar) as external_id,
  case o_orderkey % 3 when 0 then 'entregue' when 1 then 'aguardando transporte' else 'cancelado' end as status,
  case when o_orderkey % 9 <> 0 and o_orderkey % 3 = 0
       then strftime(timezone('America/Sao_Paulo', (day || ' 10:15:00')::timestamp), '%Y-%m-%d %H:%M:%S') end as ordered_at,
  case when o_orderkey % 2 = 0 then 'Transp ' || cast(o_custkey % 4 as varchar) else 'Retirada na loja' end as carrier,
  case when o_orderkey % 2 = 0 then 'Cidade-' || cast(o_custkey % 7 as varchar) end as subsidiary,
  case when o_orderkey % 4 = 0 then '2026' || substr(day, 5, 6)
       else strftime(o_orderdate + to_days(cast(o_orderkey % 11 - 3 as integer)), '%Y-%m-%d') end as delivery_date,
  case when o_orderkey % 9 = 0 then null
       when o_orderkey % 4 = 0 then case when datediff('day', cast(day as date), try_cast('2026' || substr(day, 5, 6) as date)) >= 0
                                         then cast(datediff('day', cast(day as date), try_cast('2026' || substr(day, 5, 6) as date)) as integer) end
       else case when o_orderkey % 11 - 3 >= 0 then cast(o_orderkey % 11 - 3 as integer) end end as delivery_days
from o
""")
def p13_flatten_orders_tray(spark, sf_dir):
    from cargolens.functions import dates as D
    from cargolens.functions import status as S
    from cargolens.functions.text import carrier_and_subsidiary
    o = Tables(spark, sf_dir).orders
    objs = pl.expand_objects(pl.parse_payloads(o.select(_tray_page().alias("text"))), path="$.Orders")
    flat = fl.flatten_orders(objs, "tray").withColumn("platform", F.lit("tray"))
    mapped = S.map_status(flat, "platform", "status_raw", spark=spark, on_unmapped="null")
    order_day = D.zero_date_repair(F.col("order_date"), 2026)
    delivery = D.zero_date_repair(F.col("estimated_delivery_date"), 2026)
    carrier, sub = carrier_and_subsidiary(F.col("shipment"))
    return mapped.select("external_id", "status",
                         F.date_format(D.date_hour_strict(order_day, F.col("order_hour")), TS).alias("ordered_at"),
                         carrier.alias("carrier"), sub.alias("subsidiary"), delivery.alias("delivery_date"),
                         D.days_between_non_negative(order_day, delivery).alias("delivery_days"))


def _panorama_doc():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    contatos = F.array(
        F.struct(F.lit(1).alias("tipo"), F.concat(F.lit("a"), c.cast("string"), F.lit("@x.com")).alias("contato")),
        F.struct(F.lit(2).alias("tipo"), F.concat(F.lit("11-"), c.cast("string")).alias("contato")),
        F.struct(F.lit(1).alias("tipo"), F.when(k % 2 == 0, F.concat(F.lit("b"), c.cast("string"), F.lit("@x.com")))
                 .otherwise(F.lit("sem-arroba")).alias("contato")))
    return F.to_json(F.struct(
        k.cast("string").alias("id"), F.concat(F.lit("PN"), k.cast("string")).alias("codigo"),
        ((k % 18) + 1).cast("string").alias("situacaoCodigo"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 07:58:27-03")).alias("dataHora"),
        F.struct(F.when(k % 3 == 0, F.lit(None)).otherwise((k % 5) + F.lit(0.5)).alias("numeroParcelas"))
        .alias("pedidoPagamento"),
        F.struct(c.cast("string").alias("cpfCnpj"), F.concat(F.lit("Cli "), c.cast("string")).alias("nome"),
                 contatos.alias("contatos")).alias("cliente")))


_PANORAMA_STATUS = ["aguardando pagamento", "cancelado", "aprovado", "coletando", "faturando", "em transporte",
                    "entregue", "em transporte", "faturando", "aguardando transporte", "em analise", "cancelado",
                    "cancelado", "devolvido", "faturando", "cancelado", "bloqueado", "em analise"]


@query("p13_flatten_orders_panorama", oracle=f"""
select cast(o_orderkey as varchar) as external_id,
  [{", ".join("'" + s + "'" for s in _PANORAMA_STATUS)}][o_orderkey % 18 + 1] as status,
  strftime(o_orderdate + interval 10 hour + interval 58 minute + interval 27 second, '%Y-%m-%d %H:%M:%S') as ordered_at,
  case when o_orderkey % 3 = 0 then 1 else greatest(1, cast(floor(o_orderkey % 5 + 0.5) as bigint)) end as installments,
  case when o_orderkey % 2 = 0 then 'b' else 'a' end || cast(o_custkey as varchar) || '@x.com' as email,
  '11-' || cast(o_custkey as varchar) as phone
from orders
""")
def p13_flatten_orders_panorama(spark, sf_dir):
    from cargolens.functions import dates as D
    from cargolens.functions import status as S
    from cargolens.functions.parse import installments
    o = Tables(spark, sf_dir).orders
    objs = pl.expand_objects(pl.parse_payloads(o.select(_panorama_doc().alias("text"))))
    flat = fl.flatten_orders(objs, "panorama", keep=("obj",)).withColumn("platform", F.lit("panorama"))
    mapped = S.map_status(flat, "platform", "status_code", spark=spark, on_unmapped="null")
    contacts = pl.pick_array(F.col("obj"), "$.cliente.contatos")
    return mapped.select("external_id", "status",
                         F.date_format(D.short_offset_timestamp(F.col("date_time")), TS).alias("ordered_at"),
                         installments(F.col("installments")).alias("installments"),
                         fl.last_contact(contacts, 1, "@").alias("email"), fl.last_contact(contacts, 2).alias("phone"))
