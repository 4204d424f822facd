"""Batch build: ingest -> validate -> monthly facts -> staging -> sector
analysis -> relations, every result written as parquet.

Each step writes its output to ``out_dir`` (a shared folder on a cluster)
and the next step reads the written table back: lineage is cut at every
sink, so an executor lost late in the build only re-runs the current step.
The tables of a build lie aside until its last one is written; then a manifest
names them (``sources.publish``), so a build that dies leaves the earlier one.
"""
from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import flows as FL
from ..operators import quality as QA
from ..operators import relations as RL
from ..operators import sector as SC
from ..operators import stages as ST
from ..operators import summary as SM
from ..sources.ingest import write_parquet
from ..sources.publish import new_build, publish

log = logging.getLogger(__name__)


class ValidationError(RuntimeError):
    pass


#: What a fit raises when its labels or rows are unfit, as against a failed job.
LABELS_UNFIT = (ValueError, ZeroDivisionError, IllegalArgumentException)


@dataclass
class BuildConfig:
    out_dir: str
    as_of: str
    months_window: int = 6
    relations_window: int = 12
    top_relations: int = 10
    date_floor: str | None = None
    strict: bool = True
    run_ensemble: bool = True


def _sink(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    if partition_by:
        # rows of a partition meet first (large ones in several tasks): few files each
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    write_parquet(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)  # an empty partitioned table has no file to infer from


def build_all(spark: SparkSession, base1: DataFrame, base2: DataFrame, cfg: BuildConfig) -> dict[str, str]:
    """Run the whole build; returns the written table paths by name."""
    out = new_build(cfg.out_dir)
    paths: dict[str, str] = {}

    def sink(name, df, partition_by=None):
        paths[name] = f"{out}/{name}"
        return _sink(spark, df, paths[name], partition_by)

    b1 = sink("base1", base1)
    b2 = sink("base2", base2, ["DT_REFE"])  # month partitions: window filters prune files
    checks = QA.validate(b1, b2, cfg.date_floor) if cfg.date_floor else QA.validate(b1, b2)
    failed = [r["check"] for r in checks.filter("failed").collect()]  # at most six rows
    if failed and cfg.strict:
        raise ValidationError(f"validation failed: {failed}")

    flows = sink("monthly_flows", FL.monthly_flows(b2))
    f = sink("f_empresa_mes", FL.f_empresa_mes(b1, flows))
    feats = sink("stage_features", FT.stage_features(f, cfg.months_window))
    unsup = sink("estagio_unsupervised", ST.stage_unsupervised(feats))
    edges = sink("edges_month", FL.edges_month(b2), ["year_month"])
    sup = sink("supervised_features", FT.supervised_features(b1, flows, edges, cfg.as_of))
    try:
        pred, ev = ST.stage_supervised(sup)
    except LABELS_UNFIT:
        # the labels cannot be fitted (none, or none of a class); a failed job is not caught and ends the build
        log.exception("supervised staging failed; the unsupervised stages are used instead")
        sink("estagio", unsup)
        stages = unsup.select("ID", "estagio", "confianca")
    else:
        est = sink("estagio", pred)
        sink("estagio_eval", ev)
        latest = F.struct("DT_REFE", "estagio", "confianca")  # the stage of the latest month
        stages = est.groupBy("ID").agg(F.max(latest).alias("s")).select("ID", "s.estagio", "s.confianca")
    rep = FL.flows_for_reporting(f)
    summary = sink("company_summary", SM.company_summary(rep, b1, stages))
    profile = sink("company_profile", FT.company_profile(summary, sup, stages))
    if cfg.run_ensemble:
        ens, info, _ = ST.stage_ensemble(profile)
        sink("estagio_ensemble", ens)
        sink("ensemble_weights", info)
    sink("sector_analysis", SC.competitive_analysis(profile))

    imp = RL.relation_importance(edges, cfg.relations_window)
    sink("relations_latest", RL.top_relations(imp, b1, cfg.top_relations))
    publish(spark, cfg.out_dir, paths)
    return paths
