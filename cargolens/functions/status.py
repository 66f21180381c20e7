"""Partner order-status maps (N16) and the custom status map parser.

The maps are a small dimension (platform, key, status) joined by
broadcast: its size is fixed by the values below plus the per-company
override rows, which come from configuration, not from data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The canonical order statuses.
ORDER_STATUSES = [
    "novo", "aguardando pagamento", "pendente", "em analise", "aprovado", "faturando", "coletando",
    "aguardando disponibilidade", "aguardando transporte", "em transporte", "entregue marketplace",
    "entregue", "devolvido", "cancelado", "frete não atendido", "desmembrado", "bloqueado",
]

# Precode status (lower-case key) → canonical status.
PRECODE_STATUS = {
    "novo": "novo", "analisando": "em analise", "aprovado": "aprovado", "faturando": "faturando",
    "coletando": "coletando", "em viagem": "em transporte", "entregue": "entregue",
    "devolvido": "devolvido", "cancelado": "cancelado", "bloqueado": "bloqueado",
    "retornando": "devolvido", "retornou": "devolvido", "devolvendo": "devolvido",
    "solicitado devolução": "devolvido", "desmembrado": "desmembrado",
}

# Tray default status (lower-case key) → canonical status.
TRAY_STATUS = {
    "aguardando pagamento": "aguardando pagamento", "aguardando envio": "aguardando transporte",
    "a enviar": "aguardando transporte", "enviado": "entregue", "finalizado": "entregue",
    "cancelado": "cancelado", "cancelado aut": "cancelado", "compra em analise": "em analise",
    "pendente": "pendente", "em monitoramento": "em transporte",
    "aguardando disponibilidade": "aguardando disponibilidade", "entregue leroy": "entregue marketplace",
    "frete não atendido": "frete não atendido", "a enviar yapay": "em analise",
    "aguardando yapay": "aguardando pagamento", "a enviar vindi": "em analise",
    "aguardando vindi": "aguardando pagamento",
}

# AnyMarket status (upper-case key) → canonical status.
ANYMARKET_STATUS = {
    "CONCLUDED": "entregue", "CANCELED": "cancelado", "CANCELLED": "cancelado", "INVOICED": "faturando",
    "PAID_WAITING_DELIVERY": "em transporte", "PAID_WAITING_SHIP": "aguardando transporte",
    "PENDING": "aguardando pagamento",
}

# Panorama situation code → canonical status.
PANORAMA_STATUS = {
    "1": "aguardando pagamento", "2": "cancelado", "3": "aprovado", "4": "coletando", "5": "faturando",
    "6": "em transporte", "7": "entregue", "8": "em transporte", "9": "faturando",
    "10": "aguardando transporte", "11": "em analise", "12": "cancelado", "13": "cancelado",
    "14": "devolvido", "15": "faturando", "16": "cancelado", "17": "bloqueado", "18": "em analise",
}

PLATFORM_MAPS = {"precode": PRECODE_STATUS, "tray": TRAY_STATUS, "anymarket": ANYMARKET_STATUS,
                 "panorama": PANORAMA_STATUS}


def status_key(platform: str, raw: Column) -> Column:
    """How each platform normalises its raw status before the lookup."""
    s = raw.cast("string")
    if platform == "anymarket":
        return F.upper(F.trim(s))
    if platform == "panorama":
        d = F.regexp_extract(F.trim(s), r"^[+-]?\d+", 0)
        return F.when(d != "", d.try_cast("bigint").cast("string"))
    return F.lower(F.trim(s))


def status_dimension(spark: SparkSession) -> DataFrame:
    rows = [(p, k, v) for p, m in PLATFORM_MAPS.items() for k, v in m.items()]
    return spark.createDataFrame(rows, "platform string, status_key string, status string")


def parse_custom_status_map(entries_json: Column) -> Column:
    """JSON array of objects → array<struct<status_key, status>>.

    The source key is the first non-empty string among ``key, tray, from,
    status``; the target the first among ``value, our, to, mapped``. Entries
    whose target is not a canonical status are dropped.
    """
    arr = F.try_variant_get(F.try_parse_json(entries_json), "$", "array<variant>")

    def first_string(v, names):
        opts = [F.when((F.schema_of_variant(F.variant_get(v, f"$.{n}", "variant")) == "STRING")
                       & (F.variant_get(v, f"$.{n}", "string") != ""),
                       F.variant_get(v, f"$.{n}", "string")) for n in names]
        return F.coalesce(*opts)

    pairs = F.transform(arr, lambda v: F.struct(
        F.lower(F.trim(first_string(v, ["key", "tray", "from", "status"]))).alias("status_key"),
        first_string(v, ["value", "our", "to", "mapped"]).alias("status")))
    return F.filter(F.coalesce(pairs, F.array().cast("array<struct<status_key:string,status:string>>")),
                    lambda p: p["status_key"].isNotNull() & p["status"].isin(ORDER_STATUSES))


def custom_status_rows(config: DataFrame, company_col: str = "company_id",
                       json_col: str = "status_map") -> DataFrame:
    """Per-company override rows ``(company_id, status_key, status)``; the
    last entry for a key wins, as object assignment does."""
    ex = config.select(company_col, F.posexplode(parse_custom_status_map(F.col(json_col))).alias("pos", "e"))
    last = ex.groupBy(company_col, F.col("e.status_key").alias("status_key")).agg(
        F.max(F.struct("pos", F.col("e.status").alias("status"))).alias("m"))
    return last.select(company_col, "status_key", F.col("m.status").alias("status"))


def map_status(df: DataFrame, platform_col: str, raw_col: str, *, spark: SparkSession,
               overrides: DataFrame | None = None, company_col: str = "company_id",
               on_unmapped: str = "error", out_col: str = "status") -> DataFrame:
    """Canonical status from the platform maps; company overrides win.

    ``on_unmapped``: ``'error'`` fails the job on an unmapped status,
    ``'null'`` keeps the row with a null status (the raw code stays),
    ``'quarantine'`` adds a boolean ``status_unmapped`` column for a split.
    """
    key = F.coalesce(*[F.when(F.col(platform_col) == p, status_key(p, F.col(raw_col))) for p in PLATFORM_MAPS])
    d = df.withColumn("_skey", key)
    dim = F.broadcast(status_dimension(spark).toDF("_dp", "_dk", "_base"))
    d = d.join(dim, (d[platform_col] == dim["_dp"]) & (d["_skey"] == dim["_dk"]), "left").drop("_dp", "_dk")
    if overrides is not None:
        # Override rows come from configuration; no hint: the planner
        # broadcasts them only when their measured size allows it.
        ov = overrides.select(F.col(company_col).alias("_oc"), F.col("status_key").alias("_ok"),
                              F.col("status").alias("_over"))
        d = d.join(ov, (d[company_col] == ov["_oc"]) & (d["_skey"] == ov["_ok"])
                   & (d[platform_col] == F.lit("tray")), "left").drop("_oc", "_ok")
        st = F.coalesce(F.col("_over"), F.col("_base"))
    else:
        st = F.col("_base")
    if on_unmapped == "error":
        st = F.when(st.isNull(), F.raise_error(F.concat(F.lit("unmapped status: "), F.col(raw_col).cast("string"))
                                               ).cast("string")).otherwise(st)
    out = d.withColumn(out_col, st)
    if on_unmapped == "quarantine":
        out = out.withColumn("status_unmapped", F.col(out_col).isNull())
    return out.drop("_skey", "_base", "_over")
