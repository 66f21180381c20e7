"""Staged partner tables (P13–P17, I8): documents built per row from the test
tables, parsed and written once per partner, and their child tables.

The documents hold what partners send: numbers as text, blanks, zero dates,
elements that are no objects, missing parts. The oracles compute the flat
rows from the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.operators import staging as st
from cargolens.operators.incremental import order_dates
from cargolens.plans import registry
from cargolens.sources import payload as pl
from cargolens.sources.tables import Tables

TS = "yyyy-MM-dd HH:mm:ss"
YEAR = 2026


def query(name: str, oracle: str):
    """Register with the oracle's decimal literals as doubles."""
    return registry.query(name, oracle=re.sub(r"(?<![\w.'])(\d+\.\d+)(?![\w.:'])", r"\1::double", oracle))


def document(template: str, **values: str) -> Column:
    """JSON text: every ``«name»`` of the template replaced by the SQL
    expression of that name (as text, null → ``null``)."""
    parts = []
    for piece in re.split(r"(«\w+»)", " ".join(template.split())):
        parts.append(F.expr(f"coalesce(cast({values[piece[1:-1]]} as string), 'null')") if piece.startswith("«") else F.lit(piece))
    return F.concat(*parts)


def objects_of(df: DataFrame, template: str, path: str = "$", **values: str) -> DataFrame:
    return pl.expand_objects(pl.parse_payloads(dealt(df).select(document(template, **values).alias("text"))), path=path)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all tasks: a file of few row groups is read
    by few tasks, and the work per document is far more than its bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def at(c: str) -> Column:
    return F.date_format(c, TS).alias(c)


DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"

# --- Tray ------------------------------------------------------------------------------------

TRAY_ORDER = """{"Orders": [{"Order": {"id": «k», "customer_id": "«c»", "status": " A ENVIAR ", "date": "«date»", "hour": "«hour»",
 "modified": «modified», "total": "«total»", "discount": "", "shipment_value": 12.5, "shipment": "«shipment»", "shipment_date": "«day»",
 "estimated_delivery_date": "«estimated»", "point_sale": "Loja «m»", "external_code": "X«k»", "payment_date": "0000-03-02",
 "payment_form": "pix", "sending_code": "  ", "session_id": "s«k»", "Payment": [{"id": «k»}],
 "MarketplaceOrder": [«created»],
 "ProductsSold": [{"id": "«k»-1", "product_id": "7", "quantity": "1", "price": "1.25"}, null, "x", {"product_id": 5},
                  {"id": "«k»-2", "product_id": "«p»", "quantity": "2", "price": "9.50"}, {"id": "«k»-3"}]}}, null, 4]}"""


def _tray_orders(spark, sf_dir):
    objs = objects_of(
        Tables(spark, sf_dir).orders, TRAY_ORDER, path="$.Orders", k="o_orderkey", c="o_custkey", day=DAY,
        date=f"if(o_orderkey % 9 = 0, '0000-00-00', {DAY})",
        hour="element_at(array('10:15:00', '25:00:00', ''), cast(o_orderkey % 3 + 1 as int))",
        modified=f"if(o_orderkey % 6 = 5, concat('\"', {DAY}, 'T23:00:00Z\"'), null)", total="o_totalprice",
        shipment="if(o_orderkey % 2 = 0, concat('Log - Transp ', o_custkey % 4, ' - Origem: Cidade-', o_custkey % 7), ' ')",
        estimated="if(o_orderkey % 4 = 3, '0000-00-00', date_format(date_add(o_orderdate, cast(o_orderkey % 11 as int) - 3), 'yyyy-MM-dd'))",
        m="o_custkey % 3", p="o_custkey % 50",
        created=f"case o_orderkey % 4 when 0 then concat('{{\"created\": \"', {DAY}, ' 08:30:00\"}}') when 1 then '' else '{{\"created\": \"bad\"}}' end")
    return st.staged(st.stage_tray_orders(objs, YEAR), "tray-orders")


def _tray_dates(spark, sf_dir, orders):
    t = Tables(spark, sf_dir)
    details = objects_of(
        t.orders.where("o_orderkey % 7 <> 0"), '{"«name»": {"id": "«k»", "date": «date», "hour": "«hour»", "modified": «modified»}}',
        k="o_orderkey", name="if(o_orderkey % 2 = 0, 'Order', 'order')", date=f"if(o_orderkey % 2 = 0, concat('\"', {DAY}, '\"'), null)",
        hour="if(o_orderkey % 3 = 1, '11:22:33', '')", modified=f"if(o_orderkey % 10 < 5, concat('\"', {DAY}, ' 20:00:00\"'), null)")
    details = st.staged(st.stage_tray_details(details, YEAR), "tray-details")
    known = t.orders.where("o_orderkey % 5 = 0").select(
        F.col("o_orderkey").cast("string").alias("external_id"), F.date_add("o_orderdate", 1).cast("timestamp").alias("order_date"))
    return order_dates(st.child(orders, "order"), st.child(details, "detail"), known)


_SP = "timezone('America/Sao_Paulo', ({0} || ' {1}')::timestamp)"
_TRAY_DATE_SQL = f"""
case when o_orderkey % 4 = 0 then {_SP.format("day", "08:30:00")}
     when o_orderkey % 9 <> 0 and o_orderkey % 3 = 0 then {_SP.format("day", "10:15:00")}
     when o_orderkey % 5 = 0 then (cast(o_orderdate as date) + 1)::timestamp::timestamptz
     when o_orderkey % 7 <> 0 and o_orderkey % 3 = 1 and (o_orderkey % 2 = 0 or o_orderkey % 9 <> 0) then {_SP.format("day", "11:22:33")}
     when o_orderkey % 7 <> 0 and o_orderkey % 10 < 5 then {_SP.format("day", "20:00:00")}
     when o_orderkey % 6 = 5 then (day || ' 23:00:00')::timestamp::timestamptz end"""


@query("i08_tray_order_dates", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
select cast(o_orderkey as varchar) as external_id, strftime({_TRAY_DATE_SQL} at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as order_date from o
""")
def i08_tray_order_dates(spark, sf_dir):
    return _tray_dates(spark, sf_dir, _tray_orders(spark, sf_dir)).select("external_id", at("order_date"))


TRAY_CUSTOMER = """{"Customer": {"id": «k», "cpf": "«cpf»", "cnpj": "«cnpj»", "name": " «name» ", "email": "", "birth_date": "0000-05-17",
 "gender": "«gender»", "type": "«type»", "state": " sp ", "company_name": null, "status": "«status»", "active": "0", "phone": "",
 "cellphone": "11 «k»", "zip_code": "«zip»", "city": "Cidade «city»", "address": "Rua «k»"}}"""


def _tray_customers(spark, sf_dir):
    objs = objects_of(
        Tables(spark, sf_dir).customer, TRAY_CUSTOMER, k="c_custkey", name="c_name", zip="lpad(c_custkey, 8, '0')", city="c_custkey % 9",
        cpf="if(c_custkey % 3 = 0, concat(lpad(c_custkey, 9, '1'), '-00'), '--')", cnpj="if(c_custkey % 3 = 1, concat('12.', c_custkey), '')",
        gender="element_at(array('F', '1', 'x'), cast(c_custkey % 3 + 1 as int))", type="if(c_custkey % 2 = 0, 'F', 'PJ')",
        status="if(c_custkey % 4 = 0, 'ATIVO', '?')")
    return st.staged(st.stage_tray_customers(objs, YEAR), "tray-customers")


@query("p14_tray_customers", oracle="""
select cast(c_custkey as varchar) as external_id, trim(c_name) as name,
  case c_custkey % 3 when 0 then lpad(cast(c_custkey as varchar), 9, '1') || '00' when 1 then '12' || cast(c_custkey as varchar)
       else 'tray_customer:' || cast(c_custkey as varchar) end as tax_id,
  '2026-05-17' as birth_date, case c_custkey % 3 when 0 then 'F' when 1 then 'M' end as gender,
  case when c_custkey % 2 = 0 then 'PF' else 'PJ' end as person_type, 'SP' as state, c_custkey % 4 = 0 as active,
  cast(null as varchar) as phone, '11 ' || cast(c_custkey as varchar) as cellphone, cast(c_custkey as varchar) as raw_id
from customer
""")
def p14_tray_customers(spark, sf_dir):
    c = st.child(_tray_customers(spark, sf_dir), "customer", keep=("raw",))
    return c.select("external_id", "name", "tax_id", "birth_date", "gender", "person_type", "state", "active", "phones.phone",
                    "phones.cellphone", F.get_json_object("raw", "$.Customer.id").alias("raw_id"))


@query("p13_tray_orders", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day,
  case when o_orderkey % 4 = 3 then cast(o_orderdate as date) else cast(o_orderdate as date) + cast(o_orderkey % 11 - 3 as integer) end as due
  from orders), d as (select *, {_TRAY_DATE_SQL} as dated from o)
select cast(o_orderkey as varchar) as external_id, 'A ENVIAR' as status_raw, strftime(dated at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as order_date,
  strftime(due, '%Y-%m-%d') as delivery_date,
  case when due >= cast(timezone('America/Sao_Paulo', dated) as date) then cast(due - cast(timezone('America/Sao_Paulo', dated) as date) as integer) end as delivery_days,
  '2026-03-02' as payment_date, o_totalprice as total, cast(null as double) as discount, 12.5 as freight,
  case when o_orderkey % 2 = 0 then 'Transp ' || cast(o_custkey % 4 as varchar) end as carrier,
  case when o_orderkey % 2 = 0 then 'Cidade-' || cast(o_custkey % 7 as varchar) end as subsidiary,
  'Cidade ' || cast(o_custkey % 9 as varchar) as delivery_city, 'pix' as payment_form, cast(o_orderkey as varchar) as payment_id,
  strftime(o_orderdate, '%Y-%m-%d') as shipped, 's' || cast(o_orderkey as varchar) as cart_code, cast(null as varchar) as map_code,
  cast(o_orderkey as varchar) as raw_id
from d
""")
def p13_tray_orders(spark, sf_dir):
    orders = _tray_orders(spark, sf_dir)
    o = st.tray_orders(orders, _tray_customers(spark, sf_dir), _tray_dates(spark, sf_dir, orders))
    return o.select("external_id", "status_raw", at("order_date"), "delivery_date", "delivery_days", "payment_date", "total", "discount",
                    "freight", "carrier", "subsidiary", "delivery_city", "payments.payment_form",
                    F.get_json_object("payments.payment", "$[0].id").alias("payment_id"), F.col("tracking.shipment_date").alias("shipped"),
                    "metadata.cart_code", "metadata.map_code", F.get_json_object("raw", "$.id").alias("raw_id"))


@query("p16_tray_items", oracle="""
select cast(o_orderkey as varchar) as order_id, 0 as item_index, cast(case when o_orderkey % 2 = 0 then 70 + o_orderkey % 5 else 7 end as bigint) as product_id,
  cast(case when o_orderkey % 2 = 0 then 3 else 1 end as double) as quantity, case when o_orderkey % 2 = 0 then 4.75 else 1.25 end as unit_price from orders
union all
select cast(o_orderkey as varchar), 4, cast(o_custkey % 50 as bigint), 2.0, 9.5 from orders where o_custkey % 50 <> 0
""")
def p16_tray_items(spark, sf_dir):
    sold = objects_of(Tables(spark, sf_dir).orders.where("o_orderkey % 2 = 0"),
                      '{"ProductsSold": {"id": "«k»-1", "product_id": «p», "quantity": "3", "price": 4.75}}', k="o_orderkey", p="70 + o_orderkey % 5")
    sold = st.staged(st.stage_tray_sold(sold), "tray-sold")
    return st.tray_order_items(_tray_orders(spark, sf_dir), sold).select("order_id", "item_index", "product_id", "quantity", "unit_price")


@query("p15_tray_products", oracle="""
select cast(p_partkey as varchar) as sku, p_name as name, cast(p_partkey as varchar) as store_reference, cast(p_size as varchar) as external_reference,
  case when p_partkey % 2 = 0 then p_size * 10 / 1000 end as weight_kg, cast(p_size as double) as length_cm, cast(null as double) as width_cm,
  case when p_partkey % 3 = 0 then null else cast(p_partkey % 7 as varchar) end as external_category_id,
  case when p_partkey % 4 <> 0 then 'https://i/' || cast(p_partkey as varchar) end as photo,
  case when p_partkey % 5 = 0 then 'http://u' else 'https://u' end as url
from part where p_partkey <> 0
""")
def p15_tray_products(spark, sf_dir):
    objs = objects_of(
        Tables(spark, sf_dir).part,
        """{"Products": [{"Product": {"id": "«k»", "name": "«name»", "reference": "«k»[«size»]", "weight": "«weight»", "length": "«size»",
        "width": "", "category_id": "«cat»", "brand": " «brand» ", "ProductImage": [«image»], "url": {"http": "http://u", "https": "«https»"}}},
        {"Product": {"id": 0}}, {"Product": null}, 7]}""",
        path="$.Products", k="p_partkey", name="p_name", size="p_size", weight="if(p_partkey % 2 = 0, string(p_size * 10), '-3')",
        cat="if(p_partkey % 3 = 0, ' ', string(p_partkey % 7))", brand="p_brand", https="if(p_partkey % 5 = 0, '', 'https://u')",
        image="if(p_partkey % 4 = 0, '', concat('{\"https\": \"https://i/', p_partkey, '\"}'))")
    return st.child(st.staged(st.stage_tray_products(objs), "tray-products"), "product").select(
        "sku", "name", "store_reference", "external_reference", "weight_kg", "length_cm", "width_cm", "external_category_id", "photo", "url")


# --- Precode ---------------------------------------------------------------------------------

PRECODE_ORDER = """{"codigoPedido": «k», "statusAtual": "ENTREGUE", "codigoStatusAtual": 9, "valorFrete": "«freight»", "prazoEntrega": 5,
 "valorTotalCompra": «total», "nomeAfiliado": "Afiliado", "canal": "site", "transportadora": «carrier», "nomeTransportadora": "Total",
 "retiraLoja": null, "pagamento": {"forma": "pix", "valor": «total»}, "dadosRastreio": {"cidadeDistribuicao": "Polo «m»"},
 "pedidoIndenizado": «flag», "idAfiliado": 77, "dispositivo": "app",
 "dadosAcompanhamento": [null, {"data": "x"}, {"data": "«day» 00:00", "hora": "«hour»", "descricao": "Novo"},
   {"data": "«day2»", "descricao": " Entregue "}, {"data": "«day3»", "descricao": "ENTREGUE"}, {"descricao": "entregue"}],
 "dadosCliente": {"cpfCnpj": "«doc»", "tipo": "F", "nomeRazao": "Cliente «c»", "sexo": "2", "statusCliente": "INATIVO",
   "telefones": [{"n": "«c»"}], "dadosEntrega": {"uf": " rj ", "cep": "«c»", "cidade": "Cidade «m»", "numero": 12}},
 "itens": [{"sku": "«p»", "valorUnitario": "3.50", "quantidade": 2, "tipo": "produto"}, 5, null, {"sku": 0},
   {"sku": «p2», "valorUnitario": 8, "valorUnitarioLiquido": "7.25", "quantidade": "1", "servicoRefSku": "«p»"}]}"""


def _precode_orders(spark, sf_dir):
    shifted = "date_format(date_add(o_orderdate, {0}), 'yyyy-MM-dd')"
    objs = objects_of(
        Tables(spark, sf_dir).orders, PRECODE_ORDER, k="o_orderkey", c="o_custkey", m="o_custkey % 9", total="o_totalprice", day=DAY,
        freight="if(o_orderkey % 3 = 0, '', '7.5')", carrier="if(o_orderkey % 2 = 0, '\"Azul\"', null)", flag="if(o_orderkey % 2 = 0, 'true', '\"false\"')",
        hour="element_at(array('10:15:00', '99:00:00'), cast(o_orderkey % 2 + 1 as int))", day2=shifted.format(2), day3=shifted.format(4),
        doc="if(o_orderkey % 5 = 0, ' ', concat('123.', o_custkey))", p="o_custkey % 40 + 1", p2="o_custkey % 30 + 1")
    return st.staged(st.stage_precode_orders(objs), "precode-orders")


@query("p13_precode_orders", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
select cast(o_orderkey as varchar) as external_id, 'ENTREGUE' as status_raw, case when o_orderkey % 3 <> 0 then 7.5 end as freight, o_totalprice as total,
  strftime(case when o_orderkey % 2 = 0 then {_SP.format("day", "10:15:00")} else {_SP.format("day", "00:00:00")} end at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as ordered_at,
  day as payment_date, strftime(cast(o_orderdate as date) + 4, '%Y-%m-%d') as delivery_date, case when o_orderkey % 2 = 0 then 'Azul' else 'Total' end as carrier,
  'Polo ' || cast(o_custkey % 9 as varchar) as subsidiary, cast(null as varchar) as store_pickup, 'pix' as payment_form,
  6 as timeline_entries, 77.0 as affiliate_id, o_orderkey % 2 = 0 as indemnified, cast(o_orderkey as varchar) as raw_id,
  cast(null as varchar) as raw_customer, cast(null as varchar) as raw_items
from o
""")
def p13_precode_orders(spark, sf_dir):
    o = st.child(_precode_orders(spark, sf_dir), "order", keep=("raw",))
    return o.select("external_id", "status_raw", "freight", "total", at("ordered_at"), "payment_date", "delivery_date", "carrier", "subsidiary",
                    "store_pickup", F.get_json_object("payments", "$.forma").alias("payment_form"),
                    F.json_array_length("timeline").alias("timeline_entries"), "metadata.affiliate_id", "metadata.indemnified",
                    F.get_json_object("raw", "$.codigoPedido").alias("raw_id"), F.get_json_object("raw", "$.dadosCliente").alias("raw_customer"),
                    F.get_json_object("raw", "$.itens").alias("raw_items"))


@query("p14_precode_customers", oracle="""
select '123.' || cast(o_custkey as varchar) as external_id, 'Cliente ' || cast(o_custkey as varchar) as name, 'RJ' as state, 'PF' as person_type,
  'F' as gender, false as active, cast(o_custkey as varchar) as phone, 'F' as raw_type
from orders where o_orderkey % 5 <> 0
""")
def p14_precode_customers(spark, sf_dir):
    c = st.child(_precode_orders(spark, sf_dir), "customer")
    return c.select("external_id", "name", "state", "person_type", "gender", "active", F.get_json_object("phones", "$[0].n").alias("phone"),
                    F.get_json_object("raw", "$.tipo").alias("raw_type"))


@query("p16_precode_items", oracle="""
select cast(o_orderkey as varchar) as order_id, 0 as item_index, cast(o_custkey % 40 + 1 as bigint) as sku, 3.5 as unit_price, cast(null as double) as net_unit_price,
  2.0 as quantity, 'produto' as item_type, cast(null as varchar) as service_ref_sku from orders
union all
select cast(o_orderkey as varchar), 4, cast(o_custkey % 30 + 1 as bigint), 8.0, 7.25, 1.0, null, cast(o_custkey % 40 + 1 as varchar) from orders
""")
def p16_precode_items(spark, sf_dir):
    return st.child_lines(_precode_orders(spark, sf_dir), ("order.external_id",)).withColumnRenamed("external_id", "order_id").select(
        "order_id", "item_index", "sku", "unit_price", "net_unit_price", "quantity", "item_type", "service_ref_sku")


@query("p15_precode_products", oracle="""
select cast(p_partkey as varchar) as sku, case when p_partkey % 3 = 0 then 'Lista ' || cast(p_partkey as varchar) when p_partkey % 2 = 0 then p_name else p_type end as name,
  case when p_partkey % 3 = 0 then 'R' || cast(p_partkey as varchar) else 'F' || cast(p_partkey as varchar) end as store_reference,
  case when p_partkey % 3 = 0 then null when p_partkey % 4 = 0 then 'own.jpg' else 'first.jpg' end as photo,
  case when p_partkey % 3 <> 0 then p_brand end as brand, case when p_partkey % 3 <> 0 then cast(p_size as double) end as weight,
  case when p_partkey % 3 = 0 or p_partkey % 5 = 0 then 'Lista' else 'Detalhe' end as category, 'ativo' as listed_as
from part where p_partkey <> 0
""")
def p15_precode_products(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    page = """{"p": [{"sku": "«k»", "titulo": "Lista «k»", "categoria": "Lista", "IdReferencia": "R«k»", "lista": "ativo"},
              {"sku": «k», "titulo": "Outra", "categoria": "Outra", "lista": "inativo"}, {"sku": 0}, 3]}"""
    rows = objects_of(part, page, path="$.p", k="p_partkey")
    details = objects_of(
        part.where("p_partkey % 3 <> 0"),
        """{"sku": «k», "produto": {"titulo": "«type»", "tituloCurto": «short», "codigoReferenciaFabrica": "F«k»", "marca": "«brand»", "peso": "«size»",
        "categoria": «cat», "atributos": [{"sku": 1000000000, "fotoprincipal": "first.jpg"}, {"sku": «own», "fotoprincipal": "own.jpg"}]}}""",
        k="p_partkey", type="p_type", short="if(p_partkey % 2 = 0, concat('\"', p_name, '\"'), null)", brand="p_brand", size="p_size",
        cat="if(p_partkey % 5 = 0, '\" \"', '\"Detalhe\"')", own="if(p_partkey % 4 = 0, p_partkey, -1)")
    return st.staged(st.stage_precode_products(rows, details), "precode-products").select(
        "sku", "name", "store_reference", "photo", "brand", "weight", "category", F.get_json_object("raw_list", "$.lista").alias("listed_as"))


# --- Panorama --------------------------------------------------------------------------------

PANORAMA_ORDER = """{"id": «k», "codigo": «code», "situacaoCodigo": "«status»", "dataHora": "«day» 21:58:27-03", "valorFrete": "4.5", "valorTotal": «total»,
 "formaPagamento": "boleto", "pedidoPagamento": {"numeroParcelas": 3, "nsu": "n«k»"}, "marketplace": {"codigo": "MK«k»", "marketplace": {"nome": "Loja"}},
 "endereco": {"endereco": "Rua", "cep": «c», "cidade": {"nome": "Cidade «m»", "estado": "«uf»"}},
 "transporte": {"transportadora": {"pessoa": {"nome": "Transp «m»"}}, "dataHoraLimite": "«day» 02:00:00-03"},
 "cliente": «customer»,
 "itens": [{"sku": «c», "valorUnitario": "2.5", "quantidade": 4, "descricao": "Item", "midias": {"large": "l.jpg"}}, "x", {"descricao": "no sku"},
           {"sku": "S-«k»", "valorUnitario": 1, "referencia": "R", "ean": "789", "midias": {"raw": "r.jpg"}}]}"""


def _panorama_orders(spark, sf_dir):
    objs = objects_of(
        Tables(spark, sf_dir).orders, PANORAMA_ORDER, k="o_orderkey", c="o_custkey", m="o_custkey % 9", total="o_totalprice", day=DAY,
        code="if(o_orderkey % 11 = 0, null, concat('\"PN', o_orderkey, '\"'))", status="if(o_orderkey % 13 = 0, '', string(o_orderkey % 18 + 1))",
        uf="if(o_custkey % 2 = 0, 'sp', 'Exterior')",
        customer="""if(o_orderkey % 7 = 0, null, concat('{"cpfCnpj": "', if(o_custkey % 3 = 0, lpad(o_custkey, 11, '0'), if(o_custkey % 3 = 1, '1-2', '')),
          '", "nome": "Cli ', o_custkey, '", "tipo": "', o_custkey % 3, '", "contatos": [{"tipo": 1, "contato": "a@x"}, 5, {"tipo": 1, "contato": "b"},
          {"tipo": 2, "contato": "11-', o_custkey, '"}]}'))""")
    return st.staged(st.stage_panorama_orders(objs), "panorama-orders")


_PANORAMA_KEPT = "o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0"


@query("p13_panorama_orders", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day from orders where {_PANORAMA_KEPT})
select cast(o_orderkey as varchar) as external_id, 'PN' || cast(o_orderkey as varchar) as order_code, cast(o_orderkey % 18 + 1 as varchar) as status_code,
  strftime((day || ' 21:58:27')::timestamp + interval 3 hour, '%Y-%m-%d %H:%M:%S') as ordered_at,
  strftime(timezone('America/Sao_Paulo', ((day || ' 21:58:27')::timestamp + interval 3 hour)::timestamptz), '%Y-%m-%d') as payment_date,
  4.5 as freight, o_totalprice as total, cast(3 as bigint) as installments, 'MK' || cast(o_orderkey as varchar) as partner_order_id, 'Loja' as marketplace_name,
  case when o_custkey % 2 = 0 then 'SP' else 'Exterior' end as delivery_state, cast(o_custkey as varchar) as delivery_zip,
  'Transp ' || cast(o_custkey % 9 as varchar) as carrier,
  strftime(timezone('America/Sao_Paulo', ((day || ' 02:00:00')::timestamp + interval 3 hour)::timestamptz), '%Y-%m-%d') as delivery_forecast,
  'n' || cast(o_orderkey as varchar) as nsu
from o
""")
def p13_panorama_orders(spark, sf_dir):
    o = st.child(_panorama_orders(spark, sf_dir), "order")
    return o.select("external_id", "order_code", "status_code", at("ordered_at"), "payment_date", "freight", "total", "installments",
                    "partner_order_id", "marketplace_name", "delivery_state", "delivery_zip", "carrier", "delivery_forecast",
                    F.get_json_object("payments", "$.nsu").alias("nsu"))


@query("p14_panorama_customers", oracle=f"""
select case o_custkey % 3 when 0 then lpad(cast(o_custkey as varchar), 11, '0') when 1 then '1-2' else 'panorama_cliente_' || cast(o_orderkey as varchar) end as tax_id,
  'Cli ' || cast(o_custkey as varchar) as name, case when o_custkey % 3 = 2 then 'PJ' else 'PF' end as person_type, 'a@x' as email,
  '11-' || cast(o_custkey as varchar) as cellphone
from orders where {_PANORAMA_KEPT} and o_orderkey % 7 <> 0
""")
def p14_panorama_customers(spark, sf_dir):
    return st.child(_panorama_orders(spark, sf_dir), "customer").select("tax_id", "name", "person_type", "email", "cellphone")


@query("p16_panorama_items", oracle=f"""
select cast(o_orderkey as varchar) as order_id, 0 as item_index, cast(o_custkey as varchar) as sku, 2.5 as unit_price, 4.0 as quantity, 'Item' as name, 'l.jpg' as photo
from orders where {_PANORAMA_KEPT}
union all select cast(o_orderkey as varchar), 3, 'S-' || cast(o_orderkey as varchar), 1.0, null, null, 'r.jpg' from orders where {_PANORAMA_KEPT}
""")
def p16_panorama_items(spark, sf_dir):
    return st.child_lines(_panorama_orders(spark, sf_dir), ("order.external_id",)).select(
        F.col("external_id").alias("order_id"), "item_index", "sku", "unit_price", "quantity", "name", "photo")


# --- AnyMarket -------------------------------------------------------------------------------

ANYMARKET_ORDER = """{"id": «k», "status": "CONCLUDED", "createdAt": "«day»T08:00:00-03:00", "paymentDate": «paid», "total": "«total»", "freight": 3,
 "marketPlaceNumber": "N«k»", "marketPlace": "MP", "payments": [{"method": "pix"}], "metadata": {"k": "«m»"},
 "buyer": {"document": "«doc»", "name": "Cliente «c»", "documentType": "cpf", "dateOfBirth": "1990-01-02T00:00:00Z", "cellPhone": "9«c»"},
 "shipping": {"state": "SP", "street": "Rua", "promisedShippingTime": "«due»T00:00:00Z"}, "tracking": «tracking»,
 "items": [{"amount": 2, "sellPrice": "5.5", "sku": {"id": «s», "ean": "E«s»", "title": "T«s»"}, "product": {"id": «p», "title": "P«p»"}}, null, 3,
           {"amount": 4, "total": 10, "sku": {"partnerId": "«s»[«m»]"}}]}"""


def anymarket_orders(spark, sf_dir):
    objs = objects_of(
        Tables(spark, sf_dir).orders, ANYMARKET_ORDER, k="o_orderkey", c="o_custkey", m="o_custkey % 9", s="o_custkey % 97 + 1", p="o_custkey % 53",
        total="o_totalprice", day=DAY, due=f"date_format(date_add(o_orderdate, cast(o_orderkey % 5 as int) - 1), 'yyyy-MM-dd')",
        paid=f"if(o_orderkey % 2 = 0, concat('\"', {DAY}, 'T10:00:00Z\"'), null)", doc="if(o_orderkey % 10 = 0, '-', lpad(o_custkey, 11, '0'))",
        tracking="if(o_orderkey % 3 = 0, null, '{\"carrier\": \"Azul\", \"deliveryMethodName\": \"Normal\"}')")
    return st.staged(st.stage_anymarket_orders(objs), "anymarket-orders")


@query("p13_anymarket_orders", oracle="""
select cast(o_orderkey as varchar) as external_id,
  case when o_orderkey % 10 = 0 then 'anymarket_buyer:' || cast(o_orderkey as varchar) else lpad(cast(o_custkey as varchar), 11, '0') end as customer_ref,
  'N' || cast(o_orderkey as varchar) as partner_order_id, 'MP' as marketplace_name,
  strftime(o_orderdate::date + interval 11 hour, '%Y-%m-%d %H:%M:%S') as ordered_at, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') end as payment_date,
  o_totalprice as total, 3.0 as freight, 'Rua' as delivery_address, cast(o_orderkey % 5 - 1 as integer) as delivery_days,
  case when o_orderkey % 3 <> 0 then 'Azul' end as carrier, case when o_orderkey % 3 <> 0 then 'Normal' end as subsidiary, 'pix' as method,
  cast(o_custkey % 9 as varchar) as meta, 'SP' as tracked_state
from orders where o_orderkey <> 0
""")
def p13_anymarket_orders(spark, sf_dir):
    o = st.child(anymarket_orders(spark, sf_dir), "order")
    return o.select("external_id", "customer_ref", "partner_order_id", "marketplace_name", at("ordered_at"), "payment_date", "total", "freight",
                    "delivery_address", "delivery_days", "carrier", "subsidiary", F.get_json_object("payments", "$[0].method").alias("method"),
                    F.get_json_object("metadata", "$.k").alias("meta"), F.get_json_object("tracking", "$.state").alias("tracked_state"))


# --- freight ---------------------------------------------------------------------------------

QUOTE = """{"retorno": {"idCotacao": "Q«k»", "plataforma": "allpost", "dataCotacao": "«day» 22:15:00", "destino": {"uf": "SP", "cep": «c»}},
 "dadosEntrada": {"canal": "«ch»", "nomeLoja": "Loja", "carrinho": {"valorNF": "«total»", "totalVolumes": 2,
   "produto": [5, {"sku": "«c»-1", "idSku": "«k»", "qt": "2", "preco": 3.5}, null, {"idSku": "x1", "precoCanalDe": "9.9"}]}},
 "limiteCotacaoLoja": 7, "tempo": {"ms": «m»},
 "opcoesEntrega": [1, null, {"freteCobrar": "«value»", "freteReal": 2, "prazoEntregaTotal": 6, "possuiEstoque": "sim",
   "dadosFrete": {"transportadoraNome": "T«m»", "filialUF": "RJ"}, "prazoEntrega": {"prazoTransportadora": "4"}}, "s", {"prazoEntregaTotal": "x"}]}"""


def _quotes(spark, sf_dir):
    objs = objects_of(Tables(spark, sf_dir).orders, QUOTE, k="o_orderkey", c="o_custkey", m="o_custkey % 9", ch="o_orderpriority",
                      total="o_totalprice", value="o_orderkey % 100 / 4", day=DAY)
    return st.staged(st.stage_freight_quotes(objs), "freight-quotes")


@query("p17_quote_headers", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
select 'Q' || cast(o_orderkey as varchar) as quote_id, strftime({_SP.format("day", "22:15:00")} at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as quoted_at,
  strftime(timezone('America/Sao_Paulo', {_SP.format("day", "22:15:00")}), '%Y-%m-%d') as date, cast(o_custkey as varchar) as destination_zip, o_orderpriority as channel,
  'Loja' as store_name, o_totalprice as invoice_value, 2.0 as total_packages, 7.0 as store_limit, cast(o_custkey % 9 as varchar) as ms
from o
""")
def p17_quote_headers(spark, sf_dir):
    return st.child(_quotes(spark, sf_dir), "quote").select(
        "quote_id", at("quoted_at"), "date", "destination_zip", "channel", "store_name", "invoice_value", "total_packages", "store_limit",
        F.get_json_object("timings", "$.ms").alias("ms"))


@query("p17_quote_option_rows", oracle="""
select 'Q' || cast(o_orderkey as varchar) as quote_id, 2 as line_index, (o_orderkey % 100) / 4 as shipping_value, 2.0 as shipping_cost, 6.0 as deadline,
  4.0 as carrier_deadline, 'T' || cast(o_custkey % 9 as varchar) as carrier, 'RJ' as warehouse_uf, true as has_stock from orders
union all select 'Q' || cast(o_orderkey as varchar), 4, null, null, null, null, null, null, false from orders
""")
def p17_quote_option_rows(spark, sf_dir):
    return st.child_lines(_quotes(spark, sf_dir), ("quote.quote_id",), "options").select(
        "quote_id", "line_index", "shipping_value", "shipping_cost", "deadline", "carrier_deadline", "carrier", "warehouse_uf",
        F.coalesce("has_stock", F.lit(False)).alias("has_stock"))


@query("p17_quote_cart_rows", oracle="""
select 'Q' || cast(o_orderkey as varchar) as quote_id, 1 as line_index, cast(o_custkey as varchar) || '-1' as partner_sku, cast(o_orderkey as varchar) as partner_sku_id,
  2.0 as quantity, 3.5 as price, cast(null as double) as channel_price_from from orders
union all select 'Q' || cast(o_orderkey as varchar), 3, null, null, null, null, 9.9 from orders
""")
def p17_quote_cart_rows(spark, sf_dir):
    return st.child_lines(_quotes(spark, sf_dir), ("quote.quote_id",), "items").select(
        "quote_id", "line_index", "partner_sku", "partner_sku_id", "quantity", "price", "channel_price_from")


FREIGHT_ORDER = """{"_id": "F«k»", "numeroPedido": "tray-«k»", "idCotacao": "Q«k»", "canal": "site", "data": "«day» 10:00:00", "valorFretePedido": "«value»",
 "valorFreteReal": 8, "enderecoEntrega": {"uf": "SP", "referencia": "casa"},
 "envio": [null, {"prazoEntregaPedido": "«due1» 12:00:00", "dataEntrega": "", "diferencaPedidoCotacao": -2, "notaFiscal": {"valorTotalProdutos": "«nf»"},
   "produtos": [{"sku": "A", "idSku": "«c»", "quantidade": 1, "categoria": "", "categoriaCadastro": "cad"}, null, 7, {"skuLoja": "L«k»", "preco": "2.5"}]}«more»]}"""


def _freight_orders(spark, sf_dir):
    second = """concat(', {"prazoEntregaPedido": "', date_format(date_add(o_orderdate, 9), 'yyyy-MM-dd'), 'T12:00:00Z", "dataEntrega": "',
      date_format(date_add(o_orderdate, 5), 'yyyy-MM-dd'), ' 09:00:00", "diferencaPedidoCotacao": "1.5", "notaFiscal": {"valorTotalProdutos": 10},
      "produtos": [{"sku": "B", "idSku": "x"}]}')"""
    objs = objects_of(
        Tables(spark, sf_dir).orders, FREIGHT_ORDER, k="o_orderkey", c="o_custkey", day=DAY, value="o_orderkey % 50 / 4", nf="if(o_orderkey % 3 = 0, '', '5')",
        due1="date_format(date_add(o_orderdate, 4), 'yyyy-MM-dd')", more=f"if(o_orderkey % 2 = 0, {second}, '')")
    return st.staged(st.stage_freight_orders(objs), "freight-orders")


@query("p17_freight_order_headers", oracle=f"""
with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate::date + 4, '%Y-%m-%d') as due, strftime(o_orderdate::date + 5, '%Y-%m-%d') as done from orders),
d as (select *, case when o_orderkey % 2 = 0 then (o_orderdate::date + 9 + interval 12 hour)::timestamptz else {_SP.format("due", "12:00:00")} end as promised,
  {_SP.format("day", "10:00:00")} as ordered from o)
select 'F' || cast(o_orderkey as varchar) as external_id, cast(o_orderkey as varchar) as order_code, strftime(ordered at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as ordered_at,
  (o_orderkey % 50) / 4 as freight_amount, 8.0 as freight_cost,
  case when o_orderkey % 3 <> 0 then 5.0 + case when o_orderkey % 2 = 0 then 10 else 0 end when o_orderkey % 2 = 0 then 10.0 end as invoice_value,
  strftime(promised at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as estimated_delivery_at,
  case when o_orderkey % 2 = 0 then strftime({_SP.format("done", "09:00:00")} at time zone 'UTC', '%Y-%m-%d %H:%M:%S') end as delivered_at,
  case when o_orderkey % 2 = 0 then 1.5 else -2.0 end as delta_delivery,
  cast(timezone('America/Sao_Paulo', promised)::date - timezone('America/Sao_Paulo', ordered)::date as integer) as delivery_days, 'casa' as address_complement
from d
""")
def p17_freight_order_headers(spark, sf_dir):
    return st.child(_freight_orders(spark, sf_dir), "order").select(
        "external_id", "order_code", at("ordered_at"), "freight_amount", "freight_cost", "invoice_value", at("estimated_delivery_at"), at("delivered_at"),
        "delta_delivery", "delivery_days", "address_complement")


@query("p17_freight_order_lines", oracle="""
select 'F' || cast(o_orderkey as varchar) as order_id, 0 as line_index, 1 as envio_index, 'A' as partner_sku, cast(o_custkey as varchar) as partner_sku_id, 'cad' as category,
  cast(null as double) as price from orders
union all select 'F' || cast(o_orderkey as varchar), 1, 1, 'L' || cast(o_orderkey as varchar), null, null, 2.5 from orders
union all select 'F' || cast(o_orderkey as varchar), 2, 2, 'B', null, null, null from orders where o_orderkey % 2 = 0
""")
def p17_freight_order_lines(spark, sf_dir):
    return st.child_lines(_freight_orders(spark, sf_dir), ("order.external_id",)).select(
        F.col("external_id").alias("order_id"), "line_index", "envio_index", "partner_sku", "partner_sku_id", "category", "price")


# --- bookings --------------------------------------------------------------------------------

EVENT = """{"id": «k», "date": "«day»", "start_time": "«time»", "status": "«status»", "insurance": «insurance», "added_by": "u«m»",
 "patient": {"id": «patient», "code": "«code»", "name": "Paciente «c»", "gender": "«gender»", "mobile_phone": «phone»},
 "procedures": [{"procedure": {"id": 1, "name": "Consulta", "event_procedure_value": "100.555", "event_procedure_quantity": 0}}, {"x": 1},
                {"procedure": {"id": "2", "name": "Exame", "event_procedure_value": null}}]}"""
TRANSACTION = """{"discount": "«discount»", "value": "«value»", "pay_date": "«day»", "procedures": [null, {"id": 9, "name": "Exame", "value": "«v1»", "quantity": "2"},
 {"procedure_id": 8, "id": 1, "name": "Consulta", "value": 50.005}, {"id": 7, "name": "Fora", "value": 5, "deleted": true}, {"id": 6, "value": 3},
 {"id": 5, "name": "Estorno", "value": "-10.10"}, {"id": 4, "name": "Curativo", "value": 20}]}"""


def _bookings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    events = objects_of(
        t.orders, EVENT, k="o_orderkey", c="o_custkey", m="o_custkey % 9", day=DAY, time="if(o_orderkey % 2 = 0, '08:30', 'x')",
        status="if(o_orderkey % 10 = 9, 'na', 'ok')", insurance="element_at(array('{\"name\": \"Plano\"}', '\"Texto\"', 'null'), cast(o_orderkey % 3 + 1 as int))",
        patient="if(o_orderkey % 8 = 0, if(o_orderkey % 16 = 0, null, 0), o_custkey)", code="if(o_custkey % 2 = 0, '', concat('P', o_custkey))",
        gender="element_at(array('f', ' M ', 'outro'), cast(o_custkey % 3 + 1 as int))", phone="if(o_custkey % 5 = 0, null, concat('\"11', o_custkey, '\"'))")
    paid = dealt(t.orders.where("o_orderkey % 4 <> 3")).select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 2, F.lit("{}")).otherwise(document(
        TRANSACTION, discount="if(o_orderkey % 3 = 0, '', string(o_orderkey % 90 + 0.335D))", value="o_totalprice", day=DAY, v1="o_orderkey % 40 + 0.1")).alias("text"))
    transactions = pl.expand_objects(pl.parse_payloads(paid)).select(F.col("o_orderkey").cast("string").alias("event_id"), "obj")
    return st.staged(st.stage_bookings(events, transactions), "bookings")


_PAID = "(o_orderkey % 4 in (0, 1) and o_orderkey % 10 <> 9)"


@query("p13_bookings", oracle=f"""
select cast(o_orderkey as varchar) as external_id, case when o_orderkey % 10 = 9 then 'na' else 'ok' end as status_code,
  strftime(o_orderdate::date + case when o_orderkey % 2 = 0 then interval '11:30:00' else interval '03:00:00' end, '%Y-%m-%d %H:%M:%S') as ordered_at,
  case when {_PAID} then floor(o_totalprice * 100 + 0.5) / 100 end as total, case when {_PAID} then strftime(o_orderdate, '%Y-%m-%d') end as payment_date,
  cast(o_custkey as varchar) as customer_ref, case o_orderkey % 3 when 0 then 'Plano' when 1 then 'Texto' end as insurance, 'u' || cast(o_custkey % 9 as varchar) as added_by
from orders where o_orderkey % 8 <> 0 and o_custkey <> 0
""")
def p13_bookings(spark, sf_dir):
    return st.child(_bookings(spark, sf_dir), "order").select("external_id", "status_code", at("ordered_at"), "total", "payment_date", "customer_ref",
                                                              "metadata.insurance", "metadata.added_by")


@query("p14_patients", oracle="""
select cast(o_custkey as varchar) as external_id, case when o_custkey % 2 = 0 then 'ICLINIC-P-' || cast(o_custkey as varchar) else 'P' || cast(o_custkey as varchar) end as tax_id,
  'Paciente ' || cast(o_custkey as varchar) as trade_name, case o_custkey % 3 when 0 then 'F' when 1 then 'M' end as gender,
  case when o_custkey % 5 <> 0 then '11' || cast(o_custkey as varchar) end as mobile, 'iclinic_patient' as segmentation
from orders where o_orderkey % 8 <> 0 and o_custkey <> 0
""")
def p14_patients(spark, sf_dir):
    return st.child(_bookings(spark, sf_dir), "customer").select("external_id", "tax_id", "trade_name", "gender", "phones.mobile", "segmentation")


@query("p16_booking_items", oracle=f"""
with recursive e as (select *, {_PAID} as paid from orders where o_orderkey % 8 <> 0 and o_custkey <> 0),
l as (select o_orderkey, 1 as line_index, 9 as sku, 'Exame' as name, (o_orderkey % 40) * 100 + 10 as v, 2 as quantity, false as first_line from e where paid
  union all select o_orderkey, 2, 8, 'Consulta', 5001, 1, true from e where paid
  union all select o_orderkey, 5, 5, 'Estorno', -1010, 1, false from e where paid
  union all select o_orderkey, 6, 4, 'Curativo', 2000, 1, false from e where paid),
o as (select l.*, case when o_orderkey % 3 = 0 then 0 else cast(floor((o_orderkey % 90 + 0.335::double) * 100 + 0.5) as bigint) end as d,
  row_number() over (partition by o_orderkey order by first_line desc, v desc, line_index) as k from l),
r as (select o_orderkey, line_index, sku, name, v, quantity, k, v - case when d > 0 then least(v, d) else 0 end as paid, case when d > 0 then d - least(v, d) else 0 end as rest from o where k = 1
  union all
  select o.o_orderkey, o.line_index, o.sku, o.name, o.v, o.quantity, o.k, o.v - case when r.rest > 0 then least(o.v, r.rest) else 0 end,
    case when r.rest > 0 then r.rest - least(o.v, r.rest) else 0 end from r join o on r.o_orderkey = o.o_orderkey and o.k = r.k + 1)
select cast(o_orderkey as varchar) as order_id, cast(o_orderkey as varchar) || '-' || cast(sku as varchar) as external_id, cast(sku as bigint) as sku, name,
  v / 100 as value, paid / 100 as unit_price, cast(quantity as bigint) as quantity, 'transaction' as source from r
union all select cast(o_orderkey as varchar), cast(o_orderkey as varchar) || '-1', 1, 'Consulta', 100.56, 100.56, 1, 'event' from e where not paid
union all select cast(o_orderkey as varchar), cast(o_orderkey as varchar) || '-2', 2, 'Exame', 0.0, 0.0, 1, 'event' from e where not paid
""")
def p16_booking_items(spark, sf_dir):
    return st.booking_items(_bookings(spark, sf_dir)).drop("line_index")
