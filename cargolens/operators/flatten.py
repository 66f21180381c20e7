"""Partner payload flattening (P13–P17, N32, N37, N41) over VARIANT
objects produced by ``sources.payload``.

Each partner's order / customer shape is a field spec (output column →
JSON path and kind) applied with the P18 pickers; line arrays are
expanded with ``posexplode`` so positions survive. All work is per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.dates import parse_timestamp
from cargolens.functions.parse import unit_price
from cargolens.functions.text import join_non_blank, split_store_reference, tax_id_any
from cargolens.sources.payload import pick_array, pick_number, pick_object, pick_string

# JSON paths of the order fields of each partner's payload.
ORDER_SPECS: dict[str, dict[str, tuple[str, str]]] = {
    "anymarket": {
        "external_id": ("$.id", "string"), "status_raw": ("$.status", "string"),
        "created_at": ("$.createdAt", "timestamp"), "payment_date": ("$.paymentDate", "string"),
        "total": ("$.total", "number"), "discount": ("$.discount", "number"), "freight": ("$.freight", "number"),
        "marketplace_id": ("$.marketPlaceId", "string"), "account_name": ("$.accountName", "string"),
        "delivery_state": ("$.shipping.state", "string"), "delivery_zip": ("$.shipping.zipCode", "string"),
        "delivery_city": ("$.shipping.city", "string"), "delivery_neighborhood": ("$.shipping.neighborhood", "string"),
        "delivery_number": ("$.shipping.number", "string"), "promised_at": ("$.shipping.promisedShippingTime", "string"),
    },
    "tray": {
        "external_id": ("$.Order.id", "string"), "customer_ref": ("$.Order.customer_id", "string"),
        "status_raw": ("$.Order.status", "string"), "order_date": ("$.Order.date", "string"),
        "order_hour": ("$.Order.hour", "string"), "modified": ("$.Order.modified", "string"),
        "total": ("$.Order.total", "number"), "discount": ("$.Order.discount", "number"),
        "freight": ("$.Order.shipment_value", "number"), "shipment": ("$.Order.shipment", "string"),
        "shipment_date": ("$.Order.shipment_date", "string"),
        "estimated_delivery_date": ("$.Order.estimated_delivery_date", "string"),
        "point_sale": ("$.Order.point_sale", "string"), "external_code": ("$.Order.external_code", "string"),
        "payment_date": ("$.Order.payment_date", "string"), "coupon": ("$.Order.discount_coupon", "string"),
    },
    "precode": {
        "external_id": ("$.codigoPedido", "string"), "partner_order": ("$.pedidoParceiro", "string"),
        "status_raw": ("$.statusAtual", "string"), "freight": ("$.valorFrete", "number"),
        "delivery_days": ("$.prazoEntrega", "number"), "delivery_forecast": ("$.previsaoEntrega", "string"),
        "total": ("$.valorTotalCompra", "number"), "discount": ("$.valorTotalDesconto", "number"),
        "affiliate": ("$.nomeAfiliado", "string"), "channel": ("$.canal", "string"),
        "delivery_state": ("$.dadosCliente.dadosEntrega.uf", "string"),
        "delivery_city": ("$.dadosCliente.dadosEntrega.cidade", "string"),
    },
    "panorama": {
        "external_id": ("$.id", "string"), "order_code": ("$.codigo", "string"),
        "status_code": ("$.situacaoCodigo", "string"), "status_name": ("$.situacaoNome", "string"),
        "date_time": ("$.dataHora", "string"), "freight": ("$.valorFrete", "number"),
        "total": ("$.valorTotal", "number"), "discount": ("$.valorDesconto", "number"),
        "payment_type": ("$.formaPagamento", "string"), "installments": ("$.pedidoPagamento.numeroParcelas", "number"),
        "marketplace": ("$.marketplace.marketplace.nome", "string"),
        "delivery_city": ("$.endereco.cidade.nome", "string"), "delivery_state": ("$.endereco.cidade.estado", "string"),
    },
}

# JSON paths of the buyer / customer fields.
CUSTOMER_SPECS: dict[str, dict[str, tuple[str, str]]] = {
    "anymarket": {"tax_id_raw": ("$.buyer.documentNumberNormalized", "string"),
                  "document": ("$.buyer.document", "string"), "name": ("$.buyer.name", "string"),
                  "email": ("$.buyer.email", "string"), "birth_date": ("$.buyer.dateOfBirth", "string"),
                  "document_type": ("$.buyer.documentType", "string"), "cell_phone": ("$.buyer.cellPhone", "string")},
    "precode": {"tax_id_raw": ("$.dadosCliente.cpfCnpj", "string"), "person_type": ("$.dadosCliente.tipo", "string"),
                "name": ("$.dadosCliente.nomeRazao", "string"), "trade_name": ("$.dadosCliente.fantasia", "string"),
                "gender": ("$.dadosCliente.sexo", "string"), "birth_date": ("$.dadosCliente.dataNascimento", "string"),
                "email": ("$.dadosCliente.email", "string")},
    "panorama": {"tax_id_raw": ("$.cliente.cpfCnpj", "string"), "name": ("$.cliente.nome", "string"),
                 "trade_name": ("$.cliente.nomeFantasia", "string"), "person_type": ("$.cliente.tipo", "string")},
}


def _pick(v: Column, path: str, kind: str) -> Column:
    if kind == "number":
        return pick_number(v, path)
    if kind == "timestamp":
        return parse_timestamp(pick_string(v, path))
    if kind == "object":
        return pick_object(v, path)
    return pick_string(v, path)


def apply_spec(df: DataFrame, obj_col: str, spec: Mapping[str, tuple[str, str]], keep: tuple = ()) -> DataFrame:
    """Project the fields of a spec out of the VARIANT column ``obj_col``."""
    v = F.col(obj_col)
    return df.select(*keep, *[_pick(v, p, k).alias(name) for name, (p, k) in spec.items()])


def flatten_orders(df: DataFrame, partner: str, obj_col: str = "obj", keep: tuple = ()) -> DataFrame:
    """Canonical order columns from a partner order object."""
    return apply_spec(df, obj_col, ORDER_SPECS[partner], keep)


def flatten_customers(df: DataFrame, partner: str, obj_col: str = "obj", keep: tuple = (),
                      synthetic_prefix: str | None = None, id_path: str = "$.id") -> DataFrame:
    """The buyer as a customer row; the tax id is its digits (N18),
    else a synthetic id ``prefix + order id`` when a prefix is given."""
    out = apply_spec(df, obj_col, CUSTOMER_SPECS[partner], (*keep, obj_col))
    tax = tax_id_any(F.coalesce(F.col("tax_id_raw"), F.col("document") if "document" in out.columns else F.lit(None)))
    if synthetic_prefix is not None:
        tax = F.coalesce(tax, F.concat(F.lit(synthetic_prefix), pick_string(F.col(obj_col), id_path)))
    return out.withColumn("tax_id", tax).drop(obj_col)


def anymarket_carrier(v: Column) -> tuple[Column, Column]:
    """N32 (marketplace): tracking.carrier (+ deliveryMethodName as
    subsidiary); without tracking, the first item's first shipping carrier,
    falling back to its shipping type when missing or UNKNOWN."""
    tracking = pick_object(v, "$.tracking")
    first_ship = "$.items[0].shippings[0]"
    ship_carrier = pick_string(v, f"{first_ship}.shippingCarrierNormalized")
    from_ship = F.when(ship_carrier.isNull() | (ship_carrier == "UNKNOWN"),
                       F.coalesce(pick_string(v, f"{first_ship}.shippingtype"), ship_carrier)).otherwise(ship_carrier)
    carrier = F.when(tracking.isNotNull(), pick_string(v, "$.tracking.carrier")).otherwise(from_ship)
    subsidiary = F.when(tracking.isNotNull(), pick_string(v, "$.tracking.deliveryMethodName"))
    return carrier, subsidiary


def precode_carrier(v: Column) -> Column:
    """N32 (three-field coalesce)."""
    return F.coalesce(pick_string(v, "$.dadosRastreio.transportadora"), pick_string(v, "$.transportadora"),
                      pick_string(v, "$.nomeTransportadora"))


def delivery_complement(v: Column) -> Column:
    """N39 on the marketplace shipping comment and reference."""
    return join_non_blank(pick_string(v, "$.shipping.comment"), pick_string(v, "$.shipping.reference"))


def order_items(df: DataFrame, obj_col: str, items_path: str, keep: tuple = ()) -> DataFrame:
    """One row per element of the line array, with its position."""
    return df.select(*keep, F.posexplode(pick_array(F.col(obj_col), items_path)).alias("item_index", "item"))


def anymarket_item_fields(item: Column) -> dict[str, Column]:
    """P16 (marketplace) item fields; the unit price falls back to
    total ÷ quantity (N38); the sku id is sku.id, else partnerId, else
    externalId; partnerId ``store[external]`` is split (N20)."""
    qty = pick_number(item, "$.amount")
    unit = F.coalesce(pick_number(item, "$.sellPrice"), pick_number(item, "$.unit"))
    total = pick_number(item, "$.total")
    store, ext = split_store_reference(F.coalesce(pick_string(item, "$.sku.partnerId"),
                                                  pick_string(item, "$.sku.externalId")))
    return {
        "sku_id": F.coalesce(pick_string(item, "$.sku.id"), pick_string(item, "$.sku.partnerId"),
                             pick_string(item, "$.sku.externalId")),
        "ean": pick_string(item, "$.sku.ean"), "title": pick_string(item, "$.sku.title"),
        "quantity": qty, "unit_price": unit_price(unit, total, qty),
        "total": total, "store_reference": store, "external_reference": ext,
    }


def main_image(images: Column) -> Column:
    """The image flagged main, else the one with index 1, else the
    first; its first http URL among five fields; else the first image that
    has one."""
    def url(i):
        u = F.coalesce(*[pick_string(i, f"$.{k}") for k in
                         ("url", "standardUrl", "thumbnailUrl", "lowResolutionUrl", "originalImage")])
        return F.when(u.startswith("http"), u)

    objs = F.filter(images, lambda i: F.schema_of_variant(i).startswith("OBJECT"))
    is_main = lambda i: (F.coalesce(F.try_variant_get(i, "$.main", "string"), F.lit("")).isin("true", "1"))
    chosen = F.coalesce(F.try_element_at(F.filter(objs, is_main), F.lit(1)),
                        F.try_element_at(F.filter(objs, lambda i: pick_number(i, "$.index") == 1), F.lit(1)),
                        F.try_element_at(objs, F.lit(1)))
    any_url = F.try_element_at(F.filter(F.transform(objs, url), lambda u: u.isNotNull()), F.lit(1))
    return F.coalesce(url(chosen), any_url)


def product_skus(df: DataFrame, obj_col: str = "obj", keep: tuple = ()) -> DataFrame:
    """Product × sku → one product row per sku, with the product's
    main image (N37)."""
    v = F.col(obj_col)
    base = df.select(*keep, pick_string(v, "$.id").alias("product_external_id"),
                     pick_string(v, "$.title").alias("product_title"),
                     main_image(pick_array(v, "$.images")).alias("photo"),
                     F.posexplode(pick_array(v, "$.skus")).alias("sku_index", "sku"))
    s = F.col("sku")
    store, ext = split_store_reference(pick_string(s, "$.partnerId"))
    return base.select(*keep, "product_external_id", "product_title", "photo", "sku_index",
                       pick_string(s, "$.id").alias("sku"), pick_string(s, "$.ean").alias("ean"),
                       F.coalesce(pick_string(s, "$.title"), F.col("product_title")).alias("name"),
                       pick_number(s, "$.price").alias("price"), store.alias("store_reference"),
                       ext.alias("external_reference"))


def freight_quote_rows(df: DataFrame, obj_col: str = "obj") -> dict[str, DataFrame]:
    """P17 (quotes): the quote row, its delivery options
    (``opcoesEntrega[]``) and its cart items (``carrinho.produto[]``), each
    with its position; elements that are no objects are no rows."""
    v = F.col(obj_col)
    qid = pick_string(v, "$.retorno.idCotacao")
    quote = df.select(qid.alias("quote_id"), pick_string(v, "$.retorno.plataforma").alias("platform"),
                      parse_timestamp(pick_string(v, "$.retorno.dataCotacao")).alias("quoted_at"),
                      pick_string(v, "$.retorno.destino.uf").alias("destination_state"),
                      pick_string(v, "$.dadosEntrada.canal").alias("channel"),
                      pick_number(v, "$.dadosEntrada.carrinho.valorNF").alias("invoice_value"))
    is_object = lambda x: F.schema_of_variant(F.col(x)).startswith("OBJECT")
    opts = df.select(qid.alias("quote_id"), F.posexplode(pick_array(v, "$.opcoesEntrega")).alias("line_index", "o")).where(is_object("o"))
    o = F.col("o")
    options = opts.select("quote_id", "line_index", pick_number(o, "$.freteCobrar").alias("shipping_value"),
                          pick_number(o, "$.freteReal").alias("real_value"),
                          pick_number(o, "$.prazoEntregaTotal").cast("int").alias("deadline"),
                          pick_number(o, "$.prazoEntrega.prazoTransportadora").cast("int").alias("carrier_deadline"),
                          pick_string(o, "$.dadosFrete.transportadoraNome").alias("carrier"))
    its = df.select(qid.alias("quote_id"),
                    F.posexplode(pick_array(v, "$.dadosEntrada.carrinho.produto")).alias("line_index", "p")).where(is_object("p"))
    p = F.col("p")
    items = its.select("quote_id", "line_index", pick_string(p, "$.sku").alias("partner_sku"),
                       pick_string(p, "$.idSku").alias("id_sku"), pick_number(p, "$.qt").alias("quantity"),
                       pick_number(p, "$.preco").alias("price"))
    return {"quotes": quote, "options": options, "items": items}


def freight_order_items(df: DataFrame, obj_col: str = "obj") -> DataFrame:
    """P17 (freight orders): products of every shipment, with a running
    ``line_index`` over all shipments and the shipment's ``envio_index``."""
    v = F.col(obj_col)
    envios = pick_array(v, "$.envio")
    nested = F.transform(envios, lambda e, i: F.transform(
        F.filter(pick_array(e, "$.produtos"), lambda p: F.schema_of_variant(p).startswith("OBJECT")),
        lambda p: F.struct(i.alias("envio_index"), p.alias("p"))))
    ex = df.select(pick_string(v, "$._id").alias("freight_order_id"),
                   F.posexplode(F.flatten(nested)).alias("line_index", "x"))
    p = F.col("x.p")
    return ex.select("freight_order_id", "line_index", F.col("x.envio_index").alias("envio_index"),
                     F.coalesce(pick_string(p, "$.sku"), pick_string(p, "$.skuLoja")).alias("partner_sku"),
                     pick_string(p, "$.idSku").alias("id_sku"), pick_number(p, "$.quantidade").alias("quantity"),
                     pick_number(p, "$.preco").alias("price"))


def patient_tax_id(code: Column, patient_id: Column, prefix: str = "ICLINIC-P-") -> Column:
    """The patient code, else a prefixed id."""
    c = F.trim(code.cast("string"))
    return F.when(c != "", c).otherwise(F.concat(F.lit(prefix), patient_id.cast("string")))


def contact_fields(contact) -> Column:
    """Type (``tipo``) and text of a contact."""
    return F.struct(pick_number(contact, "$.tipo").alias("kind"), pick_string(contact, "$.contato").alias("contact"))


def last_contact(contacts: Column, kind: int, must_contain: str | None = None) -> Column:
    """The last contact of a type (``tipo``) — e.g. the last e-mail
    (type 1, containing '@') or the last phone (type 2) — of an array of VARIANT."""
    return last_contact_of(F.transform(contacts, contact_fields), kind, must_contain)


def last_contact_of(contacts: Column, kind: int, must_contain: str | None = None) -> Column:
    """``last_contact`` of an array of ``contact_fields``."""
    def ok(c):
        cond = (c["kind"] == kind) & c["contact"].isNotNull()
        return cond & (F.instr(c["contact"], must_contain) > 0) if must_contain else cond
    return F.try_element_at(F.filter(contacts, ok), F.lit(-1))["contact"]
