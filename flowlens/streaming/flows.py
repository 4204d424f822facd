"""Incremental monthly flows with Structured Streaming.

The ledger arrives as parquet files in a folder; each micro-batch adds its
payments to the per-(company, month) revenue/expense state (Spark's
stateful streaming aggregation, checkpointed in ``checkpoint_location``),
and the updated groups are merged into a parquet snapshot by
``foreachBatch``.  Growth and volatility, which need the ordered history,
are derived from the snapshot with the batch operator.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flows as FL
from ..schemas import BASE2


def monthly_totals_stream(spark: SparkSession, ledger_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming (company, month) -> revenue, expense totals."""
    led = (spark.readStream.schema(BASE2).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(ledger_dir))
    legs = led.filter(F.col("DT_REFE").isNotNull()).select(
        "DT_REFE",
        F.explode(F.array(
            F.struct(F.col("ID_RCBE").alias("ID"), F.col("VL").alias("rec"), F.lit(0.0).alias("des")),
            F.struct(F.col("ID_PGTO").alias("ID"), F.lit(0.0).alias("rec"), F.col("VL").alias("des")),
        )).alias("leg"))
    return (legs.filter(F.col("leg.ID").isNotNull())
            .groupBy(F.col("leg.ID").alias("ID"), F.col("DT_REFE").alias("year_month"))
            .agg(F.sum("leg.rec").alias("receita_mensal"), F.sum("leg.des").alias("despesa_mensal")))


def snapshot_versions(spark: SparkSession, snapshot_dir: str) -> list[int]:
    """Versions that were written to the end, oldest first (any file system Spark reads)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(snapshot_dir)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder)]
    done = [p.getName() for p in names
            if p.getName().startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n[2:]) for n in done)


def latest_snapshot(spark: SparkSession, snapshot_dir: str) -> DataFrame | None:
    versions = snapshot_versions(spark, snapshot_dir)
    return spark.read.parquet(f"{snapshot_dir.rstrip('/')}/v={versions[-1]:08d}") if versions else None


def run_monthly_flows(spark: SparkSession, ledger_dir: str, snapshot_dir: str, checkpoint_location: str,
                      available_now: bool = True):
    """Start the stream; every micro-batch replaces the updated (company,
    month) groups in the snapshot (anti-join on the keys + union), written
    to a new version folder so readers never see a half-written table.

    The version before a batch is looked up in the snapshot folder, so a
    stream that is stopped and restarted on its checkpoint goes on from there,
    and a batch that is run again overwrites its own version.
    """
    root = snapshot_dir.rstrip("/")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        earlier = [v for v in snapshot_versions(spark, root) if v < epoch_id]
        merged = batch
        if earlier:
            prev = spark.read.parquet(f"{root}/v={earlier[-1]:08d}")
            merged = prev.join(batch.select("ID", "year_month"), ["ID", "year_month"], "left_anti").unionByName(batch)
        merged.write.mode("overwrite").parquet(f"{root}/v={epoch_id:08d}")

    writer = (monthly_totals_stream(spark, ledger_dir).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint_location).foreachBatch(upsert))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def flows_from_snapshot(snapshot: DataFrame) -> DataFrame:
    """Full monthly flows (with growth and volatility) from a snapshot of
    the streamed totals."""
    base = snapshot.select("ID", "year_month", "receita_mensal", "despesa_mensal")
    return FL.flows_window(base)
