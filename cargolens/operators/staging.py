"""Staged partner tables (P13–P17): every payload is parsed once.

``stage_*`` turns a partner's VARIANT objects into one typed row per object:
a struct for the order (or quote, product …), one for the customer, an array
of structs for the lines, and ``raw``, the object as JSON text. ``staged``
writes such a table once; the child tables are plain selects and explodes of
it, with no JSON work left, and read only the columns they need.

Line arrays keep the position in the payload (``item_index``); elements that
are not objects are no lines. All functions are per row; money stays as the
number the partner sent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions import dates as D
from cargolens.functions import parse as N
from cargolens.functions import text as T
from cargolens.operators.flatten import anymarket_carrier, anymarket_item_fields, contact_fields, delivery_complement, last_contact_of, patient_tax_id
from cargolens.session import write_once
from cargolens.sources.payload import Fields, once, pick_number, pick_object, pick_string

OBJ = "obj"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a staged table once under the shared folder and read it back."""
    return write_once(df, f"staged-{name}")


def child(df: DataFrame, struct: str, keep: tuple = ()) -> DataFrame:
    """The rows of one struct of a staged table; rows without it are left out."""
    return df.where(F.col(struct).isNotNull()).select(*keep, f"{struct}.*")


def child_lines(df: DataFrame, keep: tuple, lines: str = "lines") -> DataFrame:
    """One row per line, beside the columns ``keep`` of its parent."""
    names = [k.split(".")[-1] for k in keep]
    return (df.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.explode(lines).alias("_line"))
            .select(*names, "_line.*"))


def json_of(v: Column, path: str = "$") -> Column:
    """A part of the payload as JSON text; null where it is missing or null."""
    return F.nullif(F.to_json(F.try_variant_get(v, path, "variant")), F.lit("null"))


def is_object(v: Column, path: str = "$") -> Column:
    """Whether there is an object (only an object can be cast to a struct)."""
    return F.try_variant_get(v, path, "struct<_: variant>").isNotNull()


def json_part(f: Fields, path: str) -> Column:
    """``json_of`` for a part of decoded fields."""
    return F.nullif(F.to_json(f.part(path)), F.lit("null"))


def objects(f: Fields, path: str, make: Callable[[Fields], dict[str, Column]], index: str = "item_index", raw: bool = False) -> Column:
    """Array of structs of an array's objects, with their positions (``raw``:
    and with their JSON text)."""
    if raw:
        parts = f.part(path, "array<variant>")
        return f.rows(path, lambda i, x: _struct({index: i, **make(x), "raw": F.to_json(F.get(parts, i))}))
    return f.rows(path, lambda i, x: _struct({index: i, **make(x)}))


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _texts(v: Column | Fields, at: str, **paths: str) -> dict[str, Column]:
    return {name: pick_string(v, f"{at}.{path}") for name, path in paths.items()}


def _numbers(v: Column | Fields, at: str, **paths: str) -> dict[str, Column]:
    return {name: pick_number(v, f"{at}.{path}") for name, path in paths.items()}


def numeric_text(v: Column | Fields, path: str) -> Column:
    """Text of digits only, else null."""
    return once(pick_string(v, path), lambda s: F.when(s.rlike(r"^\d+$"), s))


def sql_datetime(c: Column, zone: str = D.SAO_PAULO) -> Column:
    """``YYYY-MM-DD HH:mm:ss`` as local time, any other text as an instant."""
    def read(s: Column) -> Column:
        local = s.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$")
        return F.when(local, D.date_hour_strict(F.substring(s, 1, 10), F.substring(s, 12, 8), zone)).otherwise(D.parse_timestamp(s))
    return once(N.ws_trim(c), read)


# --- Tray: orders, customers, sold products, catalogue ---------------------------------------

def stage_tray_orders(objs: DataFrame, as_of_year: int, keep: tuple = ()) -> DataFrame:
    """Elements of ``Orders[]``. The delivery fields belong to the customer
    payload, the order date to the cascade I8 (``incremental.order_dates``),
    which reads created_sql, list_date, list_hour and modified."""
    v, f, o = F.col(OBJ), Fields(), "$.Order"
    day = lambda path: once(pick_string(f, f"{o}.{path}"), lambda s: D.zero_date_repair(s, as_of_year))
    shipment = pick_string(f, f"{o}.shipment")
    carrier, subsidiary = once(shipment, lambda s: T.carrier_and_subsidiary(s)[0]), once(shipment, lambda s: T.carrier_and_subsidiary(s)[1])
    order = _struct({
        **_texts(f, o, external_id="id", customer_ref="customer_id", status_raw="status", list_hour="hour", modified="modified",
                 marketplace_name="point_sale", partner_order_id="external_code", discount_coupon="discount_coupon"),
        **_numbers(f, o, total="total", discount="discount", freight="shipment_value"),
        "created_sql": pick_string(f, f"{o}.MarketplaceOrder[0].created"),
        "list_date": day("date"),
        "delivery_date": F.coalesce(day("estimated_delivery_date"), day("shipment_date")),
        "payment_date": day("payment_date"),
        "channel": F.lit("marketplace"), "carrier": carrier, "subsidiary": subsidiary,
        "tracking": _struct(_texts(f, o, shipment="shipment", shipment_date="shipment_date", shipment_integrator="shipment_integrator",
                                   sending_code="sending_code", tracking_url="tracking_url", access_code="access_code",
                                   is_traceable="is_traceable")),
        "payments": _struct({**_texts(f, o, payment_date="payment_date", payment_form="payment_form"),
                             "payment": json_part(f, f"{o}.Payment"), "invoice": json_part(f, f"{o}.OrderInvoice")}),
        "metadata": _struct({"source": F.lit("tray"),
                             **_texts(f, o, source_status="status", parent_order_code="id_quotation", cart_code="session_id",
                                      order_type="payment_form", dropshipping_type="shipment_integrator", map_code="sending_code")}),
    })
    lines = objects(f, f"{o}.ProductsSold", lambda p: {
        "sold_id": pick_string(p, "$.id"), "product_id": pick_number(p, "$.product_id").cast("bigint"),
        "quantity": pick_number(p, "$.quantity"), "unit_price": pick_number(p, "$.price")})
    return f.decode(objs.where(is_object(v, o)), v).select(
        *keep, order.alias("order"), lines.alias("lines"), json_of(v, o).alias("raw"))


def stage_tray_customers(objs: DataFrame, as_of_year: int, keep: tuple = ()) -> DataFrame:
    """Customer payloads: tax id from cpf, else cnpj (digits), else a synthetic id."""
    v, f, c = F.col(OBJ), Fields(), "$.Customer"
    digits = lambda path: F.nullif(T.digits_only(pick_string(f, f"{c}.{path}")), F.lit(""))
    customer = _struct({
        **_texts(f, c, external_id="id", name="name", email="email", trade_name="company_name"),
        "tax_id": F.coalesce(digits("cpf"), digits("cnpj"), F.concat(F.lit("tray_customer:"), pick_string(f, f"{c}.id"))),
        "birth_date": once(pick_string(f, f"{c}.birth_date"), lambda s: D.zero_date_repair(s, as_of_year)),
        "gender": once(pick_string(f, f"{c}.gender"), N.gender), "person_type": once(pick_string(f, f"{c}.type"), N.person_type),
        "state": once(pick_string(f, f"{c}.state"), T.brazilian_state),
        "active": F.coalesce(once(pick_string(f, f"{c}.status"), N.active_boolean), once(pick_string(f, f"{c}.active"), N.active_boolean)),
        "phones": _struct(_texts(f, c, phone="phone", cellphone="cellphone")),
        "delivery": _struct(_texts(f, c, state="state", zip="zip_code", neighborhood="neighborhood", city="city", number="number",
                                   address="address", complement="complement")),
    })
    return f.decode(objs.where(is_object(v, c)), v).select(*keep, customer.alias("customer"), json_of(v).alias("raw"))


def stage_tray_sold(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Details of sold products."""
    v, f, p = F.col(OBJ), Fields(), "$.ProductsSold"
    sold = _struct({"sold_id": pick_string(f, f"{p}.id"), "product_id": pick_number(f, f"{p}.product_id").cast("bigint"),
                    "quantity": pick_number(f, f"{p}.quantity"), "unit_price": pick_number(f, f"{p}.price")})
    return f.decode(objs.where(is_object(v, p)), v).select(*keep, sold.alias("sold"), json_of(v).alias("raw"))


def tray_order_items(orders: DataFrame, sold: DataFrame) -> DataFrame:
    """P16 (Tray): a sold line takes product, quantity and price from its
    detail payload where there is one (the first per id), else from the order;
    lines without an id or a product are left out."""
    detail = child(sold, "sold").where(F.col("sold_id").isNotNull()).groupBy("sold_id").agg(
        F.min(F.struct("product_id", "quantity", "unit_price")).alias("d"))
    lines = child_lines(orders, ("order.external_id",)).where(F.col("sold_id").isNotNull()).join(detail, "sold_id", "left")
    pick = lambda c: F.when(F.col("d").isNotNull(), F.col(f"d.{c}")).otherwise(F.col(c)).alias(c)
    return (lines.select(F.col("external_id").alias("order_id"), "item_index", "sold_id",
                         *[pick(c) for c in ("product_id", "quantity", "unit_price")], F.lit("produto").alias("item_type"))
            .where(F.coalesce(F.col("product_id"), F.lit(0)) != 0))


def stage_tray_products(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """P15 (Tray): elements of ``Products[]`` with a numeric id."""
    v, f, p = F.col(OBJ), Fields(), "$.Product"
    sku = F.format_string("%d", pick_number(f, f"{p}.id").cast("bigint"))
    store, external = T.split_store_reference(pick_string(f, f"{p}.reference"))
    category = pick_string(f, f"{p}.category_id")
    product = _struct({
        "sku": sku, "ecommerce_id": sku,
        **_texts(f, p, ean="ean", slug="slug", name="name", brand="brand", model="model", ncm="ncm", category="category_name"),
        "store_reference": store, "external_reference": external, "brand_id": pick_number(f, f"{p}.brand_id"),
        "weight_kg": N.grams_to_kg(pick_string(f, f"{p}.weight")),
        **_numbers(f, p, length_cm="length", width_cm="width", height_cm="height"),
        "external_category_id": category, "photo": pick_string(f, f"{p}.ProductImage[0].https"),
        "url": F.coalesce(pick_string(f, f"{p}.url.https"), pick_string(f, f"{p}.url.http")),
    })
    return f.decode(objs.where(F.coalesce(pick_number(v, f"{p}.id"), F.lit(0.0)) != 0), v).select(
        *keep, product.alias("product"), json_of(v, p).alias("raw"))


# --- Precode: orders with customer and lines, catalogue ---------------------------------------

def stage_precode_orders(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Order details. The order date is the first dated entry of the
    timeline with its hour, the delivery date the last entry "entregue" (A6);
    ``raw`` is the order without customer and lines."""
    v, f, c, d = F.col(OBJ), Fields(), "$.dadosCliente", "$.dadosCliente.dadosEntrega"
    dated = F.filter(objects(f, "$.dadosAcompanhamento", lambda e: {
        "date": once(pick_string(e, "$.data"), D.parse_ymd), "hour": pick_string(e, "$.hora"),
        "done": F.lower(F.coalesce(pick_string(e, "$.descricao"), F.lit(""))) == "entregue"}), lambda e: e["date"].isNotNull())
    timeline = F.col("_timeline")           # a column, so that its readers share one evaluation
    first = F.try_element_at(timeline, F.lit(1))
    tax = pick_string(f, f"{c}.cpfCnpj")
    order = _struct({
        **_texts(f, "$", external_id="codigoPedido", partner_order_id="pedidoParceiro", status_raw="statusAtual",
                 status_code="codigoStatusAtual", delivery_forecast="previsaoEntrega", marketplace_name="nomeAfiliado", channel="canal"),
        **_numbers(f, "$", freight="valorFrete", delivery_days="prazoEntrega", total="valorTotalCompra", discount="valorTotalDesconto"),
        **_texts(f, d, delivery_state="uf", delivery_zip="cep", delivery_neighborhood="bairro", delivery_city="cidade",
                 delivery_number="numero", delivery_address="endereco", delivery_complement="complemento"),
        "customer_ref": tax,
        "carrier": F.coalesce(pick_string(f, "$.dadosRastreio.transportadora"), pick_string(f, "$.transportadora"),
                              pick_string(f, "$.nomeTransportadora")),
        "subsidiary": pick_string(f, "$.dadosRastreio.cidadeDistribuicao"),
        "ordered_at": D.date_hour_lenient(first["date"], first["hour"]), "payment_date": first["date"],
        "delivery_date": F.try_element_at(F.filter(timeline, lambda e: e["done"]), F.lit(-1))["date"],
        "store_pickup": json_part(f, "$.retiraLoja"), "payments": json_part(f, "$.pagamento"),
        "tracking": json_part(f, "$.dadosRastreio"), "timeline": json_part(f, "$.dadosAcompanhamento"),
        "metadata": _struct({
            "source": F.lit("precode"),
            **_texts(f, "$", source_status="statusAtual", device="dispositivo", erp_seller="vendedorERP",
                     delivery_scheduling="agendamentoEntrega", parent_order_code="codigoPedidoPrincipal", order_type="tipoPedido",
                     dropshipping_type="pedidoDropshipping"),
            **_numbers(f, "$", affiliate_id="idAfiliado", cart_code="codigoCarrinhoCompras", map_code="codigoMapa"),
            "indemnified": f.value("$.pedidoIndenizado", "boolean")}),
    })
    customer = F.when(tax.isNotNull(), _struct({
        "external_id": tax, "tax_id": tax, "state": once(pick_string(f, f"{d}.uf"), T.brazilian_state),
        "person_type": once(pick_string(f, f"{c}.tipo"), N.person_type), "gender": once(pick_string(f, f"{c}.sexo"), N.gender),
        **_texts(f, c, name="nomeRazao", trade_name="fantasia", birth_date="dataNascimento", email="email"),
        "active": once(pick_string(f, f"{c}.statusCliente"), N.active_boolean), "phones": json_part(f, f"{c}.telefones"),
        "raw": json_of(v, c)}))
    lines = objects(f, "$.itens", lambda i: {
        "sku": pick_number(i, "$.sku").cast("bigint"), "unit_price": pick_number(i, "$.valorUnitario"),
        "net_unit_price": pick_number(i, "$.valorUnitarioLiquido"), "quantity": pick_number(i, "$.quantidade"),
        "item_type": pick_string(i, "$.tipo"), "service_ref_sku": pick_string(i, "$.servicoRefSku")})
    rest = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: ~k.isin("dadosCliente", "itens"))
    return f.decode(objs.where(is_object(v)), v).withColumn("_timeline", dated).select(
        *keep, order.alias("order"), customer.alias("customer"),
        F.filter(lines, lambda i: F.coalesce(i["sku"], F.lit(0)) != 0).alias("lines"), F.to_json(rest).alias("raw"))


def stage_precode_products(rows: DataFrame, details: DataFrame, as_of_order: str = "obj_pos") -> DataFrame:
    """P15 (Precode): rows of the product lists, first per sku (U2/W3), with
    the detail payload of that sku preferred field by field; the photo is
    that of the attribute of this sku, else of the first attribute (N37)."""
    v, f = F.col(OBJ), Fields()
    listed = (rows.where(F.coalesce(pick_number(v, "$.sku"), F.lit(0.0)) != 0)
              .select(pick_number(v, "$.sku").cast("bigint").alias("sku"), F.struct(
                  F.col(as_of_order).alias("at"), pick_string(v, "$.titulo").alias("title"), pick_string(v, "$.categoria").alias("category"),
                  pick_string(v, "$.IdReferencia").alias("reference"), json_of(v).alias("raw")).alias("l"))
              .groupBy("sku").agg(F.min("l").alias("l")))
    p = "$.produto"
    attributes = objects(f, f"{p}.atributos", lambda a: {
        "sku": pick_number(a, "$.sku"), "photo": pick_string(a, "$.fotoprincipal")}, "index")
    detail_fields = _struct({
        "name": F.coalesce(pick_string(f, f"{p}.tituloCurto"), pick_string(f, f"{p}.titulo")),
        **_texts(f, p, reference="codigoReferenciaFabrica", brand="marca", model="modelo", category="categoria",
                 subcategory="subcategoria", final_category="categoriaFinal"),
        **_numbers(f, p, weight="peso", width="largura_cm", height="altura_cm", length="profundidade_cm"),
        "ncm": F.coalesce(pick_string(v, f"{p}.NCM"), pick_string(v, f"{p}.ncm")),      # names that differ in case only: read by path
        "attributes": attributes, "raw": json_of(v)})
    detail = (f.decode(details.where(is_object(v, p)), v)
              .select(pick_number(v, "$.sku").cast("bigint").alias("sku"), detail_fields.alias("d"))
              .groupBy("sku").agg(F.min_by("d", F.xxhash64("d.raw")).alias("d")))
    own = F.try_element_at(F.filter("d.attributes", lambda a: a["sku"] == F.col("sku")), F.lit(1))
    source = F.coalesce(own, F.try_element_at(F.col("d.attributes"), F.lit(1)))
    return listed.join(detail, "sku", "left").select(
        F.col("sku").cast("string").alias("sku"), F.coalesce("d.name", "l.title").alias("name"),
        F.coalesce("d.reference", "l.reference").alias("store_reference"), source["photo"].alias("photo"),
        *[F.col(f"d.{c}").alias(c) for c in ("brand", "model", "weight", "width", "height", "length", "ncm")],
        F.coalesce("d.category", "l.category").alias("category"), "d.subcategory", "d.final_category",
        F.col("l.raw").alias("raw_list"), F.col("d.raw").alias("raw_detail"))


# --- Panorama --------------------------------------------------------------------------------

def stage_panorama_orders(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Orders with an id, a code and a status code; the order's and the
    customer's contacts, lines with a sku."""
    v, f, e, c = F.col(OBJ), Fields(), "$.endereco", "$.cliente"
    state = pick_string(f, f"{e}.cidade.estado")
    moment = pick_string(f, "$.dataHora")
    order = _struct({
        **_texts(f, "$", external_id="id", order_code="codigo", status_code="situacaoCodigo", status_name="situacaoNome",
                 payment_type="formaPagamento"),
        **_numbers(f, "$", freight="valorFrete", total="valorTotal", discount="valorDesconto"),
        **_texts(f, e, delivery_address="endereco", delivery_number="numero", delivery_neighborhood="bairro", delivery_zip="cep",
                 delivery_complement="complemento", delivery_city="cidade.nome"),
        "delivery_state": once(state, lambda s: F.coalesce(T.brazilian_state(s), s)),
        "partner_order_id": pick_string(f, "$.marketplace.codigo"),
        "marketplace_name": pick_string(f, "$.marketplace.marketplace.nome"), "channel": F.lit("marketplace"),
        "ordered_at": once(moment, D.short_offset_timestamp), "payment_date": D.brazil_date(once(moment, D.short_offset_timestamp)),
        "installments": once(pick_number(f, "$.pedidoPagamento.numeroParcelas"), N.installments),
        "payments": json_part(f, "$.pedidoPagamento"),
        "carrier": pick_string(f, "$.transporte.transportadora.pessoa.nome"),
        "delivery_forecast": D.brazil_date(once(pick_string(f, "$.transporte.dataHoraLimite"), D.short_offset_timestamp)),
    })
    contacts = f.rows(f"{c}.contatos", lambda i, x: contact_fields(x))
    document = pick_string(f, f"{c}.cpfCnpj")
    tax = F.coalesce(once(document, lambda x: F.coalesce(T.tax_id_min11(x), x)), F.concat(F.lit("panorama_cliente_"), pick_string(f, "$.id")))
    customer = F.when(pick_object(f, c).isNotNull(), _struct({
        "external_id": tax, "tax_id": tax, **_texts(f, c, name="nome", trade_name="nomeFantasia"),
        "person_type": F.when(pick_number(f, f"{c}.tipo") == 2, F.lit("PJ")).otherwise(F.lit("PF")),
        "email": last_contact_of(contacts, 1, "@"), "cellphone": last_contact_of(contacts, 2), "raw": json_part(f, c)}))
    lines = objects(f, "$.itens", lambda i: {
        "sku": pick_string(i, "$.sku"), "unit_price": pick_number(i, "$.valorUnitario"), "quantity": pick_number(i, "$.quantidade"),
        "item_type": F.lit("produto"), "name": pick_string(i, "$.descricao"), "store_reference": pick_string(i, "$.referencia"),
        "ean": pick_string(i, "$.ean"), "photo": F.coalesce(pick_string(i, "$.midias.raw"), pick_string(i, "$.midias.large"))})
    whole = pick_string(v, "$.id").isNotNull() & pick_string(v, "$.codigo").isNotNull() & pick_string(v, "$.situacaoCodigo").isNotNull()
    return f.decode(objs.where(whole), v).select(
        *keep, order.alias("order"), customer.alias("customer"),
        F.filter(lines, lambda i: i["sku"].isNotNull()).alias("lines"), json_of(v).alias("raw"))


# --- AnyMarket -------------------------------------------------------------------------------

def stage_anymarket_orders(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Orders with a numeric id: order, buyer and lines (with the item's
    product for the cascade J7)."""
    v, f, s, b = F.col(OBJ), Fields(), "$.shipping", "$.buyer"
    carrier, subsidiary = anymarket_carrier(f)
    created = once(pick_string(f, "$.createdAt"), D.parse_timestamp)
    promised = once(pick_string(f, f"{s}.promisedShippingTime"), D.parse_ymd)
    document = F.coalesce(pick_string(f, f"{b}.documentNumberNormalized"), pick_string(f, f"{b}.document"))
    tax = F.coalesce(once(document, T.tax_id_any), F.concat(F.lit("anymarket_buyer:"), pick_string(f, "$.id")))
    order = _struct({
        **_texts(f, "$", external_id="id", status_raw="status"), **_numbers(f, "$", total="total", discount="discount", freight="freight"),
        "customer_ref": tax,
        "partner_order_id": F.coalesce(pick_string(f, "$.marketPlaceId"), pick_string(f, "$.marketPlaceNumber")),
        "marketplace_name": F.coalesce(pick_string(f, "$.accountName"), pick_string(f, "$.marketPlace")),
        "channel": F.lit("marketplace"), "ordered_at": created, "payment_date": once(pick_string(f, "$.paymentDate"), D.parse_ymd),
        **_texts(f, s, delivery_state="state", delivery_zip="zipCode", delivery_neighborhood="neighborhood", delivery_city="city",
                 delivery_number="number"),
        "delivery_address": F.coalesce(pick_string(f, f"{s}.address"), pick_string(f, f"{s}.street")),
        "delivery_complement": delivery_complement(f), "delivery_date": promised,
        "delivery_days": D.days_between(F.date_format(created, "yyyy-MM-dd"), promised),
        "carrier": carrier, "subsidiary": subsidiary,
        "payments": json_part(f, "$.payments"), "tracking": json_part(f, s), "metadata": json_part(f, "$.metadata")})
    customer = _struct({
        "external_id": tax, "tax_id": tax, **_texts(f, b, name="name", email="email", cellphone="cellPhone"),
        "birth_date": once(pick_string(f, f"{b}.dateOfBirth"), D.parse_ymd),
        "person_type": once(pick_string(f, f"{b}.documentType"), N.person_type), "raw": json_part(f, b)})
    lines = objects(f, "$.items", lambda i: {
        **anymarket_item_fields(i), "item_type": F.lit("produto"),
        "ecommerce_id": F.format_string("%d", pick_number(i, "$.product.id").cast("bigint")),
        "product_title": pick_string(i, "$.product.title")})
    return f.decode(objs.where(F.coalesce(pick_number(v, "$.id"), F.lit(0.0)) != 0), v).select(
        *keep, order.alias("order"), customer.alias("customer"), lines.alias("lines"), json_of(v).alias("raw"))


# --- freight: quotes with options and cart, orders with shipments -------------------------------

def stage_freight_quotes(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Quotes (objects with ``retorno``), options and cart items with
    their position in the payload."""
    v, f, r, e, cart = F.col(OBJ), Fields(), "$.retorno", "$.dadosEntrada", "$.dadosEntrada.carrinho"
    quoted = sql_datetime(pick_string(f, f"{r}.dataCotacao"))
    quote = _struct({
        **_texts(f, r, quote_id="idCotacao", partner_platform="plataforma", external_quote_id="idCotacaoExterno",
                 destination_zip="destino.cep", destination_state="destino.uf", destination_state_name="destino.ufExtenso",
                 destination_state_region="destino.regiaoUf", destination_country_region="destino.regiaoPais"),
        **_texts(f, e, channel="canal", store_name="nomeLoja"),
        **_numbers(f, cart, invoice_value="valorNF", total_weight="totalPeso", total_volume="totalCubagem", total_packages="totalVolumes"),
        **_numbers(f, "$", store_limit="limiteCotacaoLoja", channel_limit="limiteCotacaoCanal"),
        "quoted_at": quoted, "date": D.brazil_date(quoted), "time": D.brazil_time(quoted),
        "timings": json_part(f, "$.tempo"), "channel_config": json_part(f, "$.configCanal"),
        "category_restrictions": json_part(f, "$.restricaoCategoria")})
    options = objects(f, "$.opcoesEntrega", lambda o: {
        **_numbers(o, "$", shipping_value="freteCobrar", shipping_cost="freteReal", deadline="prazoEntregaTotal"),
        **_texts(o, "$.dadosFrete", carrier="transportadoraNome", warehouse_uf="filialUF", warehouse_city="filialCidade",
                 warehouse_name="filialNome", shipping_name="metodoEnvioNome"),
        **_numbers(o, "$.prazoEntrega", carrier_deadline="prazoTransportadora", holiday_deadline="prazoEntregaFeriado",
                   warehouse_deadline="prazoAdicionalFilial"),
        "has_stock": once(pick_string(o, "$.possuiEstoque"), N.bool_from_unknown)}, "line_index", raw=True)
    items = objects(f, f"{cart}.produto", lambda p: {
        **_texts(p, "$", partner_sku="sku", category="categoria", aggregator="agrupador", partner_original_sku="skuOriginal"),
        "partner_sku_id": numeric_text(p, "$.idSku"),
        **_numbers(p, "$", quantity="qt", price="preco", volumes="volumes", stock="estoque", stock_product="estoqueProduto",
                   channel_price_from="precoCanalDe", registration_price="precoCadastro", channel_price_to="precoCanalPor")}, "line_index", raw=True)
    return f.decode(objs.where(is_object(v, r)), v).select(
        *keep, quote.alias("quote"), options.alias("options"), items.alias("items"), json_of(v).alias("raw"))


def stage_freight_orders(objs: DataFrame, keep: tuple = ()) -> DataFrame:
    """Freight orders. The header takes the latest promised and delivery
    date, the greatest difference and the sum of the invoices over its
    shipments (A5); lines run over all shipments (``line_index`` counts the
    lines, ``envio_index`` is the shipment's position)."""
    v, f, a = F.col(OBJ), Fields(), "$.enderecoEntrega"
    product = lambda i, p: _struct({
        "i": i, "partner_sku": F.coalesce(pick_string(p, "$.sku"), pick_string(p, "$.skuLoja")), "partner_sku_id": numeric_text(p, "$.idSku"),
        **_numbers(p, "$", quantity="quantidade", price="preco", volumes="quantidadeVolumes", weight="peso"),
        "title": pick_string(p, "$.titulo"), "variation": pick_string(p, "$.variacao"),
        "category": F.coalesce(pick_string(p, "$.categoria"), pick_string(p, "$.categoriaCadastro"))})
    sent = f.rows("$.envio", lambda i, s: _struct({
        "envio_index": i,
        "promised": sql_datetime(pick_string(s, "$.prazoEntregaPedido")), "delivered": sql_datetime(pick_string(s, "$.dataEntrega")),
        "delta": pick_number(s, "$.diferencaPedidoCotacao"), "value": pick_number(s, "$.notaFiscal.valorTotalProdutos"),
        "products": s.rows("$.produtos", product)}))
    shipments = F.col("_shipments")         # a column, so that its readers share one evaluation
    each = lambda name: F.transform(shipments, lambda s: s[name])
    values = F.filter(each("value"), lambda x: x.isNotNull())
    ordered, promised = sql_datetime(pick_string(f, "$.data")), F.array_max(each("promised"))
    order = _struct({
        **_texts(f, "$", external_id="_id", store_name="nomeLoja", quote_id="idCotacao", channel="canal"),
        "order_code": once(pick_string(f, "$.numeroPedido"), T.order_code_tail), "ordered_at": ordered,
        "date": D.brazil_date(ordered), "time": D.brazil_time(ordered),
        **_numbers(f, "$", freight_amount="valorFretePedido", freight_cost="valorFreteReal", delta_quote="valorFreteDiferencaPedidoCotacao"),
        "invoice_value": F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda x, y: x + y)),
        **_texts(f, a, address="endereco", address_zip="cep", address_state="uf", address_city="cidade", address_neighborhood="bairro",
                 address_number="numero", address_complement="referencia"),
        "estimated_delivery_at": promised, "delivered_at": F.array_max(each("delivered")), "delta_delivery": F.array_max(each("delta")),
        "delivery_days": D.days_between(D.brazil_date(ordered), D.brazil_date(promised))})
    texts = f.part("$.envio", [{"produtos": "array<variant>"}])
    nested = F.flatten(F.transform(shipments, lambda s: F.transform(s["products"], lambda p: F.struct(
        s["envio_index"].alias("e"), p.alias("p"), F.to_json(F.get(F.get(texts, s["envio_index"])["produtos"], p["i"])).alias("raw")))))
    lines = F.transform(nested, lambda x, i: _struct({
        "line_index": i, "envio_index": x["e"],
        **{c: x["p"][c] for c in ("partner_sku", "partner_sku_id", "quantity", "price", "volumes", "weight", "title", "variation", "category")},
        "raw": x["raw"]}))
    return f.decode(objs.where(pick_string(v, "$._id").isNotNull()), v).withColumn("_shipments", sent).select(
        *keep, order.alias("order"), lines.alias("lines"), json_of(v).alias("raw"))


# --- bookings (agenda events and their transactions) ------------------------------------------

def stage_bookings(events: DataFrame, transactions: DataFrame, keep: tuple = ()) -> DataFrame:
    """Events with a patient, joined with their transaction
    payload (``event_id, obj``; not for status "na"). Lines come from the
    transaction when it has content, else from the event."""
    v, f, p = F.col(OBJ), Fields(), "$.patient"
    base = (events.where(F.coalesce(pick_string(v, f"{p}.id"), F.lit("0")) != "0")
            .withColumn("_id", pick_string(v, "$.id")))
    content = transactions.where(F.size(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))) > 0).select(
        F.col("event_id").alias("_tid"), v.alias("tx"))
    j = base.join(content, (F.col("_id") == F.col("_tid")) & (F.coalesce(pick_string(v, "$.status"), F.lit("")) != "na"), "left")
    t, has = Fields("_t"), F.col("tx").isNotNull()
    line = lambda i, id_, name, value, quantity: F.struct(
        i.alias("line_index"), id_.alias("id"), name.alias("name"), value.alias("value_text"), quantity.alias("quantity"))
    sold = F.transform(
        F.filter(t.rows("$.procedures", lambda i, x: F.struct(
            line(i, F.coalesce(pick_string(x, "$.procedure_id"), pick_string(x, "$.id")), pick_string(x, "$.name"),
                 pick_string(x, "$.value"), pick_string(x, "$.quantity")).alias("line"),
            F.coalesce(x.value("$.deleted", "boolean"), F.lit(False)).alias("deleted"))), lambda s: ~s["deleted"]),
        lambda s: s["line"])
    planned = f.rows("$.procedures", lambda i, x: line(
        i, pick_string(x, "$.procedure.id"), pick_string(x, "$.procedure.name"), pick_string(x, "$.procedure.event_procedure_value"),
        pick_string(x, "$.procedure.event_procedure_quantity")))
    insurance, discount = f.part("$.insurance"), pick_string(t, "$.discount")
    mobile, home = pick_string(f, f"{p}.mobile_phone"), pick_string(f, f"{p}.home_phone")
    gender = F.upper(pick_string(f, f"{p}.gender"))
    order = _struct({
        "external_id": F.col("_id"), "order_code": F.col("_id"), "status_code": pick_string(f, "$.status"),
        "ordered_at": D.local_datetime_fixed_offset(pick_string(f, "$.date"), pick_string(f, "$.start_time")),
        "total": F.when(has, once(pick_string(t, "$.value"), N.money_2)), "payment_date": pick_string(t, "$.pay_date"),
        "channel": F.lit("iclinic"), "customer_ref": pick_string(f, f"{p}.id"),
        "metadata": _struct({**_texts(f, "$", date_added="date_added", added_by="added_by", description="description",
                                      end_time="end_time", patient_email="patient_email", raw_status="status"),
                             "insurance": F.coalesce(pick_string(f, "$.insurance.name"),
                                                     F.when(~is_object(insurance), pick_string(insurance, "$"))),
                             "pay_date": pick_string(t, "$.pay_date")})})
    patient = _struct({
        "external_id": pick_string(f, f"{p}.id"), "tax_id": patient_tax_id(F.coalesce(pick_string(f, f"{p}.code"), F.lit("")),
                                                                          pick_string(f, f"{p}.id")),
        **_texts(f, p, trade_name="name", email="email", birth_date="birth_date"),
        "gender": once(gender, lambda g: F.when(g.isin("F", "M", "B"), g)),
        "phones": F.when(mobile.isNotNull() | home.isNotNull(), F.struct(mobile.alias("mobile"), home.alias("home"))),
        "active": F.lit(True), "segmentation": F.lit("iclinic_patient"), "raw": json_part(f, p)})
    return t.decode(f.decode(j, v), F.col("tx")).select(*keep, order.alias("order"), patient.alias("customer"), F.when(has, sold).otherwise(planned).alias("lines"),
                    has.alias("from_transaction"), F.when(has, discount).alias("discount"),
                    json_of(v).alias("raw"))


def booking_items(bookings: DataFrame) -> DataFrame:
    """P16 (bookings): cleaned lines (W8) after the transaction's discount."""
    from cargolens.operators.bookings import clean_lines
    from cargolens.operators.running import discount_waterfall
    lines = bookings.select(F.col("order.external_id").alias("order_id"), "from_transaction", "discount", F.explode("lines").alias("l"))
    lines = clean_lines(lines.select("order_id", "from_transaction", "discount", "l.*"))
    paid = discount_waterfall(lines.withColumn("_visit", F.col("name") == "Consulta"), ["order_id"], "value", "discount", "_visit",
                              "line_index", out_col="unit_price")
    return paid.select("order_id", "line_index", F.concat_ws("-", "order_id", F.col("id").cast("string")).alias("external_id"),
                       F.col("id").alias("sku"), "name", "value", "unit_price", "quantity",
                       F.when(F.col("from_transaction"), F.lit("transaction")).otherwise(F.lit("event")).alias("source"))


def stage_tray_details(objs: DataFrame, as_of_year: int, keep: tuple = ()) -> DataFrame:
    """Order details fetched one by one, for the order-date cascade (I8)."""
    v, f, inner = F.col(OBJ), Fields(), lambda at: F.when(is_object(F.col(OBJ), at), F.try_variant_get(OBJ, at, "variant"))
    detail = _struct({"external_id": pick_string(f, "$.id"), "date": once(pick_string(f, "$.date"), lambda s: D.zero_date_repair(s, as_of_year)),
                      "hour": pick_string(f, "$.hour"), "modified": pick_string(f, "$.modified"),
                      "created_sql": pick_string(f, "$.MarketplaceOrder[0].created")})
    return f.decode(objs.where(is_object(v)), F.coalesce(inner("$.Order"), inner("$.order"), v)).select(
        *keep, detail.alias("detail"), json_of(v).alias("raw"))


def tray_orders(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """P13 (Tray): orders with the delivery fields of their customer payload
    and the dates of ``incremental.order_dates``."""
    delivery = customers.where("customer.external_id is not null").groupBy(F.col("customer.external_id").alias("customer_ref")).agg(
        F.min("customer.delivery").alias("_d"))
    o = child(orders, "order", keep=("raw",)).join(delivery, "customer_ref", "left").join(dates, "external_id", "left")
    day = F.when(F.col("order_date").isNotNull(), D.brazil_date(F.col("order_date")))
    fields = ("state", "zip", "neighborhood", "city", "number", "address", "complement")
    return (o.withColumn("delivery_days", D.days_between_non_negative(day, F.col("delivery_date")))
            .select("*", *[F.col(f"_d.{c}").alias(f"delivery_{c}") for c in fields]).drop("_d"))
