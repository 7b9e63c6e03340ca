"""Tables and files written and read by the engine."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import FEATURES, TARGETS, EngineConfig
from ledgerloom.operators.serving import invoice_aggregates
from ledgerloom.operators.validation import check_size

SNAPSHOT_TABLES = ("segments", "customers", "predictions", "transactions")
DATASETS = ("features", "modeling", "scored")


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index; one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)


def processed_table(kind: str, modeling: DataFrame, scored: DataFrame) -> DataFrame:
    """``features`` holds no outcome; ``modeling`` adds the targets; ``scored`` the predictions."""
    if kind not in DATASETS:
        raise ValueError("Unknown processed dataset")
    if kind == "features":
        return modeling.select("customer_id", *FEATURES)
    return modeling.select("customer_id", *FEATURES, *TARGETS) if kind == "modeling" else scored


def export_csv(modeling: DataFrame, scored: DataFrame, folder: str) -> dict:
    """Readable copies of the feature and modeling tables."""
    for kind, name in (("features", "customer_features"), ("modeling", "customers_with_targets")):
        write_csv(processed_table(kind, modeling, scored), f"{folder}/{name}")
    return {"rows": modeling.count(), "features": len(FEATURES)}


def dataset_preview(modeling: DataFrame, cfg: EngineConfig, rows: int = 100) -> tuple[DataFrame, DataFrame]:
    """A one-row description and the first rows by customer id."""
    inputs = ["customer_id", *FEATURES]
    targets = [c for c in modeling.columns if c not in inputs]
    described = modeling.agg(F.count("*").alias("rows")).select(
        "rows",
        F.lit(len(FEATURES)).alias("feature_count"),
        F.lit(cfg.cutoff).alias("cutoff"),
        F.lit(cfg.horizon_days).alias("horizon_days"),
        F.lit(",".join(FEATURES)).alias("feature_columns"),
        F.lit(",".join(targets)).alias("target_columns"),
    )
    return described, modeling.select(*inputs).orderBy("customer_id").limit(rows)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free sum of row hashes; doubles are taken to six decimals."""
    parts = [
        F.coalesce(F.format_string("%.6f", c) if t == "double" else F.col(c).cast("string"), F.lit("?"))
        for c, t in sorted(df.dtypes)
    ]
    hashed = F.conv(F.substring(F.md5(F.concat_ws("~", *parts)), 1, 8), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(hashed).cast("string").alias("digest"))


def snapshot_tables(scored: DataFrame, clean: DataFrame, cfg: EngineConfig) -> dict[str, DataFrame]:
    """The scored snapshot as four related tables."""
    payload = F.to_json(F.struct(*sorted(scored.columns)))
    return {
        "segments": scored.select(
            F.col("cluster").alias("segment_id"), F.col("segment").alias("name")
        ).dropDuplicates(),
        "customers": scored.select("customer_id", "country", payload.alias("features")),
        "predictions": scored.select(
            "customer_id",
            F.lit(cfg.cutoff).alias("as_of"),
            F.col("cluster").alias("segment_id"),
            "churn_probability",
            "predicted_clv_90d",
            payload.alias("payload"),
        ),
        "transactions": invoice_aggregates(clean, scored, cfg),
    }


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; faults of access or schema are not taken for absence."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text at ``path`` in one step: readers see the old text or the new one."""
    jvm = spark._jvm
    draft, files = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = option
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)


class Store:
    """Snapshot tables and batch history as Parquet below one folder.

    A snapshot is a folder of its own under ``versions``; the file ``current`` names the one in force and is replaced in
    one step once all tables are written, so a reader sees one snapshot whole, and a refresh that fails midway changes
    nothing. Customers and predictions are ordered by customer across their files, and a small index keeps the first and
    last customer of each file, so a lookup opens only files that can hold what it asks for.
    """

    KEYED = ("customers", "predictions")

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def version(self) -> str | None:
        """Name of the snapshot in force."""
        pointer = f"{self.folder}/current"
        return self.spark.read.text(pointer).first().value if path_exists(self.spark, pointer) else None

    def path(self, table: str) -> str:
        """Folder of one table, of the snapshot in force where it belongs to one."""
        if table == "batch_scores":
            return f"{self.folder}/{table}"
        return f"{self.folder}/versions/{self.version() or 'none'}/{table}"

    def read(self, table: str) -> DataFrame:
        """Scan of one table."""
        return self.spark.read.parquet(self.path(table))

    def is_empty(self, table: str) -> bool:
        """True while a table has not been written or has no rows."""
        return not path_exists(self.spark, self.path(table)) or self.read(table).limit(1).count() == 0

    def seed(self, tables: dict[str, DataFrame]) -> bool:
        """Write the snapshot unless predictions are there already; says whether it wrote."""
        if not self.is_empty("predictions"):
            return False
        self.refresh(tables)
        return True

    def refresh(self, tables: dict[str, DataFrame]) -> None:
        """Write a new snapshot and put it in force; the batch history and earlier snapshots stay."""
        version = uuid.uuid4().hex
        for name in SNAPSHOT_TABLES:
            path, rows = f"{self.folder}/versions/{version}/{name}", tables[name]
            if name in self.KEYED:
                rows = rows.repartitionByRange("customer_id").sortWithinPartitions("customer_id")
            rows.write.parquet(path)
            if name in self.KEYED:
                written = self.spark.read.parquet(path).select("customer_id", F.input_file_name().alias("file"))
                written.groupBy("file").agg(F.min("customer_id").alias("first"), F.max("customer_id").alias("last")).write.parquet(f"{path}_index")
        replace_text(self.spark, f"{self.folder}/current", version)

    def lookup(self, table: str, ids: Sequence[str]) -> DataFrame:
        """Rows of a keyed table for a list of customers, from the files that can hold them.

        The list travels with the query; for a whole table of customers join ``read`` instead.
        """
        wanted = sorted(set(ids))
        index = self.spark.read.parquet(f"{self.path(table)}_index")
        near = F.exists(F.array(*[F.lit(i) for i in wanted]), lambda i: (F.col("first") <= i) & (i <= F.col("last"))) if wanted else F.lit(False)
        files = [r.file for r in index.where(near).select("file").collect()]
        rows = self.spark.read.parquet(*files) if files else self.read(table).limit(0)
        return rows.where(F.col("customer_id").isin(wanted)) if wanted else rows.limit(0)

    def append_batch(self, results: DataFrame) -> str:
        """Add one scored batch under a new id and the current time; returns the id."""
        batch = uuid.uuid4().hex
        stamped = results.select(
            F.lit(batch).alias("batch_id"),
            F.current_timestamp().alias("created_at"),
            "customer_id",
            F.to_json(F.struct(*results.columns)).alias("payload"),
        )
        stamped.write.mode("append").parquet(self.path("batch_scores"))
        return batch

    def payloads(self) -> DataFrame:
        """All saved predictions as JSON."""
        return self.read("predictions").select("customer_id", "payload")


def read_upload(spark: SparkSession, path: str, cfg: EngineConfig) -> tuple[DataFrame, bool]:
    """An uploaded CSV with text columns, and whether it is an id-only list.

    Without limits in the configuration a batch may have any size.
    """
    if cfg.upload_bytes is not None:
        files = spark.read.format("binaryFile").load(path).select("length").agg(F.sum("length").alias("bytes")).first()
        if (files.bytes or 0) > cfg.upload_bytes:
            raise ValueError(f"The upload has more than {cfg.upload_bytes} bytes")
    # No schema inference: ids such as 00123 must stay text.
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if cfg.batch_limit is None:
        check_size(rows.limit(1).count(), None)
    else:
        check_size(rows.limit(cfg.batch_limit + 1).count(), cfg.batch_limit)
    return rows, rows.columns == ["customer_id"]
