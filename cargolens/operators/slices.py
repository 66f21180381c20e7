"""Slice tables with atomic commits (S9) and versioned snapshots.

Parquet folders have no transactions, so what a reader sees is decided by a
*manifest*: a small table, one file per version, that names the commit each
slice (or entity) belongs to. A writer first stores its rows under a new
commit folder, then writes the next manifest version as a single file. The
file appears with one rename, so a job that dies before leaves the old state
and one that gets through leaves the new one; rows of a dead commit are in
no manifest. There is one writer at a time.

Manifests have one row per slice and are only read by Spark; the driver
sees the version number and the names of the commit folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.upsert import null_safe_join

COMMIT = "_commit"


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest manifest, or None before the first commit."""
    try:
        versions = spark.read.parquet(f"{path}/manifest")
    except AnalysisException:
        return None
    top = versions.agg(F.max("version")).first()[0]
    return None if top is None else versions.where(F.col("version") == top)


def _publish(rows: DataFrame, path: str, before: DataFrame | None) -> int:
    """Write the next manifest version as one file."""
    version = 0 if before is None else before.select(F.max("version")).first()[0] + 1
    # overwrite: a writer that died may have left this version's folder, without a file
    rows.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    return version


def commit_slices(fresh: DataFrame, path: str, slice_cols: Sequence[str], processed: DataFrame | None = None) -> int:
    """Replace every slice that ``fresh`` holds or ``processed`` names
    (those without rows become empty; null slice values are slices too) in
    one atomic step. Returns the version."""
    spark = fresh.sparkSession
    commit = uuid.uuid4().hex
    fresh.withColumn(COMMIT, F.lit(commit)).write.parquet(f"{path}/data/{commit}")
    stored = spark.read.schema(fresh.withColumn(COMMIT, F.lit(commit)).schema).parquet(f"{path}/data/{commit}")
    touched = stored.select(*slice_cols)
    if processed is not None:
        touched = touched.unionByName(processed.select(*slice_cols))
    touched = touched.distinct()
    before = _manifest(spark, path)
    rows = touched.withColumn(COMMIT, F.lit(commit))
    if before is not None:
        rows = rows.unionByName(null_safe_join(before.drop("version"), touched, slice_cols, "left_anti"))
    return _publish(rows, path, before)


def read_slices(spark: SparkSession, path: str, slice_cols: Sequence[str]) -> DataFrame | None:
    """The rows of the last committed state (None before the first commit)."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return None
    commits = [r[0] for r in manifest.select(COMMIT).distinct().collect()]      # one per commit still in use
    rows = spark.read.parquet(*[f"{path}/data/{c}" for c in commits])
    return null_safe_join(rows, manifest.drop("version"), [*slice_cols, COMMIT], "left_semi").drop(COMMIT)


class SnapshotStore:
    """Versioned snapshots of several entities. Entities written in a run are
    seen by that run at once (later entities resolve against them) and by
    others only after ``commit``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.before = _manifest(spark, path)
        self.commits = {} if self.before is None else {r["entity"]: r[COMMIT] for r in self.before.collect()}   # a row per entity

    def read(self, entity: str) -> DataFrame | None:
        commit = self.commits.get(entity)
        return None if commit is None else self.spark.read.parquet(f"{self.path}/data/{entity}/{commit}")

    def write(self, entity: str, df: DataFrame) -> DataFrame:
        commit = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{entity}/{commit}")
        self.commits = {**self.commits, entity: commit}
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{entity}/{commit}")

    def commit(self) -> int:
        rows = self.spark.createDataFrame(sorted(self.commits.items()), f"entity string, {COMMIT} string")
        version = _publish(rows, self.path, self.before)
        self.before = _manifest(self.spark, self.path)
        return version


def sync_erp(store: SnapshotStore, incoming: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One run over the five entities in their order, each resolved
    against the fresh snapshots of those before it and stored as a new
    version; ``commit`` publishes them together.

    * representatives — S6, then the supervisor by external id or alias (J14);
    * customers_group — first row per lower(name) (W6), S5;
    * customers — fields merge (W4), representative by external id, group by
      external id, S5;
    * products — sku conflicts go (W5), S5;
    * orders — rows grouped by their external id (A3); orders whose version
      is not newer than the stored one are skipped (I2); customer, seller (J6)
      and the lines' products (J10) resolved; S5, and lines that vanished go
      (S11, I3).

    All tables carry ``company_id``. Running the same input again changes nothing.
    """
    from cargolens.operators import dedupe as dd
    from cargolens.operators import lookup as lk
    from cargolens.operators import orders as od
    from cargolens.operators.upsert import delete_vanished_children, upsert

    key = ["company_id", "external_id"]

    def text(c: str):
        return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))

    def scoped(c: str):
        return F.when(text(c).isNotNull(), F.to_json(F.struct(F.col("company_id").alias("a"), text(c).alias("b"))))

    def dim(df: DataFrame, c: str = "external_id") -> DataFrame:
        return lk.keyed_dimension(df, scoped(c), "external_id")

    def merged(entity: str, df: DataFrame, **policy) -> DataFrame:
        old = store.read(entity)
        old = df.limit(0) if old is None else old
        return store.write(entity, upsert(old, df.select(*old.columns), key, **policy).drop("_action"))

    out: dict[str, DataFrame] = {}
    reps = dd.last_wins(incoming["representatives"], key, ["name", "supervisor_key"])
    stored = store.read("representatives")
    base = reps if stored is None else upsert(stored.drop("supervisor_id"), reps, key, default="overwrite").drop("_action")
    by_alias = lk.keyed_dimension(
        base.select("company_id", "external_id", F.explode(F.array_union(
            F.array(text("external_id")), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias")), scoped("alias"), "external_id")
    out["representatives"] = store.write("representatives", lk.lookup(base, scoped("supervisor_key"), by_alias, {"external_id": "supervisor_id"}))

    named = incoming["customers_group"].withColumn("_scope", F.to_json(F.struct(F.col("company_id").alias("a"), F.lower(F.trim("name")).alias("b"))))
    groups = dd.first_wins(named.where(text("name").isNotNull()), ["_scope"], ["external_id", "name"]).drop("_scope")
    out["customers_group"] = merged("customers_group", groups)

    c = dd.last_non_null_per_column(incoming["customers"], key, ["synced_at", "name"])
    c = lk.lookup(c, scoped("rep_key"), dim(out["representatives"]), {"external_id": "representative_id"})
    c = lk.lookup(c, scoped("group_key"), dim(out["customers_group"]), {"external_id": "group_id"})
    out["customers"] = merged("customers", c)

    p = incoming["products"].withColumn("_sku", scoped("sku")).withColumn("_ext", F.col("external_id"))
    p = dd.sku_conflicts(p, "_sku", "_ext", ["external_id", "name"])[0].drop("_sku", "_ext")
    out["products"] = merged("products", p)

    rows = incoming["orders"].withColumn("_order", scoped("order_key"))
    heads, _ = od.group_rows_into_orders(rows, "_order", "item_external_id", "synced_at",
                                         ["company_id", "order_key", "ordered_at", "customer_key", "seller_key"])
    heads = heads.drop("external_id", "n_rows").withColumnRenamed("order_key", "external_id")
    stored = store.read("orders")
    if stored is not None:
        heads = od.version_filter(heads, stored, key, "version")
    heads = lk.lookup(heads, scoped("customer_key"), dim(out["customers"]), {"external_id": "customer_id"})
    heads = store.write("fresh_orders", lk.lookup(heads, scoped("seller_key"), dim(out["representatives"]), {"external_id": "seller_id"}))
    touched = heads.select("company_id", F.col("external_id").alias("order_key"))
    lines = rows.drop("_order").join(touched, ["company_id", "order_key"], "left_semi")
    lines = dd.last_wins(lines.select("company_id", "order_key", "item_external_id", "product_key", "quantity", "unit_price", "synced_at"),
                         ["company_id", "order_key", "item_external_id"], ["synced_at", "product_key", "quantity"])
    lines = lk.lookup(lines, scoped("product_key"), dim(out["products"], "sku"), {"external_id": "product_id"})
    out["orders"] = merged("orders", heads)
    stored_items = store.read("order_items")
    if stored_items is None:
        out["order_items"] = store.write("order_items", lines)
    else:
        parent = F.to_json(F.struct("company_id", "order_key")).alias("_p")
        gone = delete_vanished_children(stored_items.select("*", parent), lines.select("*", parent), "_p", "item_external_id",
                                        touched.select(parent)).drop("_p")
        out["order_items"] = store.write("order_items", upsert(gone, lines.select(*gone.columns),
                                                               ["company_id", "order_key", "item_external_id"]).drop("_action"))
    return out
