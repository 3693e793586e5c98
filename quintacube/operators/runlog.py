"""Run log: append-only states per run, and the queries over the current states.

Except for `latest_state`, the functions take the log with one row per run, as `read_log` gives it.
Every query takes the current time as an argument, so that a result can be repeated.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.operators.loads import delete_where
from quintacube.operators.staging import latest_per_key
from quintacube.sources.schemas import LOG_DDL

# States and operation names of the log.
STARTED, DONE, FAILED = "INICIADO", "SUCESSO", "ERRO"
FULL_RUN = "ETL_COMPLETO"


def _at(moment: datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def append_state(
    spark: SparkSession,
    path: str,
    operation: str,
    status: str,
    message: str,
    began: datetime,
    run_id: str | None = None,
    took: timedelta | None = None,
    error: str | None = None,
) -> str:
    """Append one state of a run that began at the given time and return its id."""
    run_id = run_id or str(uuid.uuid4())
    at = began if took is None else began + took
    row = (run_id, began, operation, status, message, took, error, None, at)
    spark.createDataFrame([row], LOG_DDL).coalesce(1).write.mode("append").parquet(path)
    return run_id


def latest_state(log: DataFrame, *tie_break: Column) -> DataFrame:
    """The newest state of each run; on equal times a final state counts over the start."""
    final = (F.col("status") != STARTED).cast("int").desc()
    newest = F.desc("data_estado" if "data_estado" in log.columns else "data_execucao")
    return latest_per_key(log, "id_log", newest, *(tie_break or (final,)))


def running(log: DataFrame, now, window: str = "1 hour") -> DataFrame:
    """One row telling whether a run was started within the window and is not finished."""
    recent = F.col("data_execucao") > _at(now) - F.expr(f"INTERVAL {window}")
    active = F.count_if((F.col("status") == STARTED) & recent)
    return log.agg((active > 0).alias("em_execucao"))


def purge_stuck(log: DataFrame, now, older_than: str = "2 minutes") -> DataFrame:
    old = F.col("data_execucao") < _at(now) - F.expr(f"INTERVAL {older_than}")
    return delete_where(log, (F.col("status") == STARTED) & old)


def last_run_steps(log: DataFrame, operation: str = FULL_RUN) -> DataFrame:
    """Steps since the last successful full run, in time order."""
    last = (
        log.where((F.col("tipo_operacao") == operation) & (F.col("status") == DONE))
        .agg(F.max("data_execucao").alias("_last"))
        .scalar()
    )
    return (
        log.where(F.col("data_execucao") >= last)
        .select("tipo_operacao", "data_execucao", "duracao", "status")
        .orderBy(F.asc_nulls_last("data_execucao"))
    )


def counts(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("tipo_operacao", "status")
        .agg(F.count("*").alias("total"))
        .orderBy(F.asc_nulls_last("tipo_operacao"))
    )


def recent(log: DataFrame, n: int = 10, *tie_break: Column) -> DataFrame:
    return log.orderBy(F.desc_nulls_first("data_execucao"), *tie_break).limit(n)


def full_runs(log: DataFrame, operation: str = FULL_RUN) -> DataFrame:
    return log.where(F.col("tipo_operacao") == operation).select(
        "tipo_operacao", "status", "data_execucao"
    )


def status_summary(
    log: DataFrame, fact: DataFrame, clients: DataFrame, products: DataFrame
) -> DataFrame:
    """Latest log time, greatest status at that time, and table sizes.

    `total_vendas` counts all fact rows, aggregates included, and the dimension counts include the
    "all" member.
    """

    def size(df: DataFrame) -> Column:
        return df.agg(F.count("*").alias("n")).scalar()

    newest = log.agg(F.max("data_execucao").alias("t")).scalar()
    return (
        log.where(F.col("data_execucao") == newest)
        .agg(
            F.max("data_execucao").alias("ultima_execucao"),
            F.max("status").alias("status"),
        )
        .select(
            "ultima_execucao",
            "status",
            size(fact).alias("total_vendas"),
            size(clients).alias("total_clientes"),
            size(products).alias("total_produtos"),
        )
    )
