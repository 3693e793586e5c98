"""Loads of a written warehouse under a run log: a full run, increments, upserts and deletes.

The warehouse's tables are versioned (`sources.versions`): a load writes beside what is in use and
publishes all tables in one step at its end, so a failure at any point leaves the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, temporary_tables, union_all
from quintacube.operators import checks, cube, increment, layout, loads, runlog, staging
from quintacube.operators.dimensions import build_dimensions, new_members
from quintacube.plans import statistics
from quintacube.sources import versions
from quintacube.sources.files import gather_files, remove, switch
from quintacube.sources.schemas import LOG_DDL
from quintacube.sources.tables import save_table

LOAD_INCREMENT = "CARGA_INCREMENTAL"
# Names of the logged steps.
CLEAR_STAGING = "LIMPAR_STAGING"
LOAD_STAGING = "CARREGAR_STAGING"
CLEAR_WAREHOUSE = "LIMPAR_DW"
LOAD_DIMENSIONS = "CARREGAR_DIMENSOES"
LOAD_FACT = "CARREGAR_FATO_OLAP"
REFRESH_STATISTICS = "ATUALIZAR_ESTATISTICAS"

DIMENSIONS = ("Dim_Tempo", "Dim_Cliente", "Dim_Funcionario", "Dim_Produto", "Dim_Loja")
FACT = "Fato_Vendas"
#: What an increment needs beside them: the summed sales, and the lookups that they were loaded with.
GRAIN, PRODUCT_LOOKUP, STORE_LOOKUP = "vendas_grao", "produto_custo", "funcionario_loja"
#: Statistics of the fact, a row a file and column.
STATISTICS = "estatisticas"
#: Tables made from one state of the fact; a version with another fact does not list them.
DERIVED = "resumo"


class AlreadyRunning(RuntimeError):
    """Another run was started within the past hour and has not finished."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def staging_path(out: str, name: str) -> str:
    return f"{out}/stg/{name}"


def warehouse_root(out: str) -> str:
    return f"{out}/dw"


def log_path(out: str) -> str:
    return f"{out}/dw/etl_log"


def read_states(spark: SparkSession, out: str) -> DataFrame:
    """Every state of every run, once; a compaction may hold some of them a second time."""
    try:
        return spark.read.schema(LOG_DDL).parquet(log_path(out)).distinct()
    except AnalysisException:
        return spark.createDataFrame([], LOG_DDL)


def read_log(spark: SparkSession, out: str) -> DataFrame:
    """The current state of every run, one row each, in the form all log functions take."""
    return runlog.latest_state(read_states(spark, out))


def compact_log(spark: SparkSession, out: str, grace: timedelta = timedelta(minutes=10)) -> int:
    """Gather the log's files of one state each into one; returns how many are left to be deleted later.

    States may be appended and read meanwhile. The gathered states appear in one rename, and files that
    they were gathered from go by a later compaction, when `grace` has passed and no reader has them
    open any more. A crash at any point leaves every state, some of them twice, which readers drop.
    """
    return gather_files(spark, log_path(out), LOG_DDL, grace)


def purge_log(spark: SparkSession, out: str, now: datetime | None = None, older_than: str = "2 minutes") -> None:
    """Remove runs from the stored log that were started but never finished, as after a crash.

    The rest of the log is written beside it and then takes its place; no run may log meanwhile.
    """
    left = runlog.purge_stuck(read_log(spark, out), now or _now(), older_than).select("id_log")
    kept = read_states(spark, out).join(left, "id_log", "left_semi")
    beside = f"{log_path(out)}_{uuid.uuid4()}"
    kept.write.parquet(beside)
    switch(spark, beside, log_path(out))


def read_warehouse(spark: SparkSession, out: str, version: versions.Version | None = None) -> dict[str, DataFrame]:
    """Dimensions and fact, all as of one version, by default the newest."""
    root = warehouse_root(out)
    version = version or versions.current(spark, root)
    tables = {name: versions.read(spark, root, version, name) for name in (*DIMENSIONS, FACT)}
    return {**tables, FACT: tables[FACT].select(*cube.COLUMNS)}


def _write_fact(rows: DataFrame, root: str) -> versions.Table:
    return versions.write(layout.clustered(rows), root, FACT, partition_by="gid")


def _publish(
    spark: SparkSession, root: str, before: versions.Version, built: Mapping[str, versions.Table], same_rows: bool = False
) -> None:
    """Publish a load; a new fact comes with its statistics and without what the old one gave."""
    tables: dict[str, versions.Table | None] = dict(built)
    if FACT in built:
        draft = versions.Version(0, {**before.tables, **built})
        tables[STATISTICS] = statistics.refreshed(spark, root, draft, FACT, STATISTICS)
        if not same_rows:
            tables |= dict.fromkeys(name for name in before.tables if name.startswith(DERIVED))
    versions.publish(spark, root, before, tables)


def fact_statistics(spark: SparkSession, out: str, by: Sequence[str] = ("gid",)) -> DataFrame:
    """Statistics of the stored fact's columns, merged from those of its files; the fact is not read."""
    return statistics.summary(spark, warehouse_root(out), FACT, STATISTICS, by)


def error_code(failure: Exception) -> str:
    """The SQL state of a Spark error that has one, or else the kind of error."""
    state = failure.getSqlState() if isinstance(failure, PySparkException) else None
    return state or type(failure).__name__


def _logged(spark: SparkSession, out: str, operation: str, work: Callable[[], None]) -> None:
    start = _now()

    def log(status: str, message: str, *more) -> str:
        return runlog.append_state(spark, log_path(out), operation, status, message, start, *more)

    run_id = log(runlog.STARTED, "Iniciado")
    try:
        work()
    except Exception as failure:
        log(runlog.FAILED, f"Erro: {failure}", run_id, _now() - start, error_code(failure))
        raise
    log(runlog.DONE, "Concluído com sucesso", run_id, _now() - start)


def full_run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    out: str,
    measures: cube.Measures = cube.Measures(),
    catalog: str | None = None,
) -> None:
    """Reload the whole warehouse below `out`.

    Every stage reads what the stage before has written, so a lost executor costs a re-read of
    files and not a recomputation of the run. With `catalog`, the tables are registered in that
    database and their optimizer statistics refreshed.
    """
    root, built = warehouse_root(out), {}
    if runlog.running(read_log(spark, out), _now()).first()["em_execucao"]:
        raise AlreadyRunning("a run that began within the past hour has not finished")
    before = versions.current(spark, root)

    def saved(name: str) -> DataFrame:
        return spark.read.parquet(staging_path(out, name))

    def load_staging() -> None:
        for name, rows in staging.build_staging(sources).items():
            save_table(rows, staging_path(out, name))

    def load_dimensions() -> None:
        stg = {name: saved(name) for name in staging.BUILDERS}
        for name, rows in build_dimensions(sources, stg).items():
            built[name] = versions.write(rows, root, name)

    def load_fact() -> None:
        stg = {name: saved(name) for name in staging.BUILDERS}
        draft = versions.Version(0, dict(built))
        dims = {name: versions.read(spark, root, draft, name) for name in DIMENSIONS}
        given = cube.cube_input(stg, dims, measures)
        built[PRODUCT_LOOKUP] = versions.write(cube.product_lookup(given), root, PRODUCT_LOOKUP)
        built[STORE_LOOKUP] = versions.write(cube.store_lookup(given), root, STORE_LOOKUP)
        draft = versions.Version(0, dict(built))
        products, stores = (versions.read(spark, root, draft, name) for name in (PRODUCT_LOOKUP, STORE_LOOKUP))
        built[GRAIN] = versions.write(cube.looked_up(cube.summed_sales(given), products, stores), root, GRAIN)
        grain = versions.read(spark, root, versions.Version(0, dict(built)), GRAIN)
        exact = cube.build_cube(replace(given, measures=cube.exact_measures(grain, measures)), grain)
        built[FACT] = _write_fact(cube.with_rounded(exact, measures), root)
        _publish(spark, root, before, built)

    def refresh_statistics() -> None:
        if catalog is None:
            return
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog}")
        names = [f"{catalog}.{name}" for name in (*DIMENSIONS, FACT)]
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            table = name.split(".")[1]
            path = f"{root}/{table}/{built[table].paths[0]}"
            spark.catalog.createTable(name, path=path, source="parquet")
        spark.catalog.recoverPartitions(names[-1])
        checks.analyze_tables(spark, names)

    def everything() -> None:
        _logged(spark, out, CLEAR_STAGING, lambda: remove(spark, f"{out}/stg"))
        _logged(spark, out, LOAD_STAGING, load_staging)
        _logged(spark, out, CLEAR_WAREHOUSE, lambda: versions.expire(spark, root))
        _logged(spark, out, LOAD_DIMENSIONS, load_dimensions)
        _logged(spark, out, LOAD_FACT, load_fact)
        _logged(spark, out, REFRESH_STATISTICS, refresh_statistics)

    with temporary_tables(spark):
        _logged(spark, out, runlog.FULL_RUN, everything)


def load_increment(
    spark: SparkSession, sources: Mapping[str, DataFrame], out: str, measures: cube.Measures = cube.Measures()
) -> None:
    """Add new sales to the stored warehouse.

    `sources` holds the new sales only, and the other tables as they are now. Dimensions get their new
    members and keep the ids of the others. The sales become a cube of their own, which is added to the
    stored rows of the same keys; only files with such rows are written anew. Stored sales are read
    only in the summed grain, and there only if a cost, a store or a client has changed.
    """
    if runlog.running(read_log(spark, out), _now()).first()["em_execucao"]:
        raise AlreadyRunning("a run that began within the past hour has not finished")
    with temporary_tables(spark):
        _logged(spark, out, LOAD_INCREMENT, lambda: _increment(spark, sources, out, measures))


def _increment(spark: SparkSession, sources: Mapping[str, DataFrame], out: str, measures: cube.Measures) -> None:
    root = warehouse_root(out)
    before = versions.current(spark, root)
    if FACT not in before.tables:
        raise ValueError("there is no warehouse to add to: make a full run first")

    def stored(name: str) -> DataFrame:
        return versions.read(spark, root, before, name)

    built: dict[str, versions.Table] = {}

    def appended(name: str, rows: DataFrame) -> None:
        if not rows.isEmpty():
            built[name] = versions.replaced(spark, root, before, name, [], versions.write(rows, root, name))

    stg = {name: cut(rows) for name, rows in staging.build_staging(sources).items()}
    dims = {}
    for name in DIMENSIONS:
        members = cut(new_members(stored(name), name, sources, stg))
        appended(name, members)
        dims[name] = cut(stored(name).unionByName(members))
        if name == "Dim_Cliente":
            new_clients = members.select("cpf")
    given = cube.cube_input(stg, dims, measures)
    products, stores = cut(cube.product_lookup(given)), cut(cube.store_lookup(given))
    old_products, old_stores, grain = stored(PRODUCT_LOOKUP), stored(STORE_LOOKUP), stored(GRAIN)
    again = increment.affected(
        grain,
        increment.changed(old_products, products, "produto"),
        increment.changed(old_stores, stores, "idFuncionario"),
        new_clients,
    )
    arrived = cube.looked_up(cube.summed_sales(given), products, stores)
    parts = [arrived.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in grain.schema.fields])]
    taken_back = None
    if again is not None:
        again = cut(again)
        taken_back = cut(increment.negated(again))
        parts.append(increment.regrained(again, products, stores))
        built[PRODUCT_LOOKUP] = versions.write(products, root, PRODUCT_LOOKUP)
        built[STORE_LOOKUP] = versions.write(stores, root, STORE_LOOKUP)
    added = cut(union_all(parts))
    appended(GRAIN, added if taken_back is None else union_all([added, taken_back]))
    fact = stored(FACT)
    exact = replace(given, measures=cube.exact_measures(grain, measures))
    delta = cut(increment.delta_cube(exact, added, stored("Dim_Cliente").where("idCliente <> -1").select("cpf", "idCliente"), taken_back))
    keys = ["gid", *cube.KEYS]
    hits = versions.files_of(versions.located(spark, root, before, FACT).join(delta.select(*keys), keys, "left_semi"), FACT)
    old = cube.unrounded(versions.read(spark, root, before, FACT, hits))
    rows = cube.with_rounded(increment.merged(old, delta), measures).select(*fact.columns)
    if not delta.isEmpty():
        built[FACT] = versions.replaced(spark, root, before, FACT, hits, _write_fact(rows, root))
    _publish(spark, root, before, built)


def _rewritten(spark: SparkSession, out: str, name: str, hits: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    """Publish a table whose files with hits are replaced by what `change` makes of their rows."""
    root = warehouse_root(out)
    before = versions.current(spark, root)
    gone = versions.files_of(hits, name)
    rows = change(versions.read(spark, root, before, name, gone))
    new = _write_fact(rows, root) if name == FACT else versions.write(rows, root, name)
    _publish(spark, root, before, {name: versions.replaced(spark, root, before, name, gone, new)})


def upsert_stored_fact(spark: SparkSession, out: str, delta: DataFrame) -> None:
    """Put cube rows into the stored fact: those of the same keys are replaced.

    Only files that hold such keys are written anew.
    """
    with temporary_tables(spark):
        fact = versions.located(spark, warehouse_root(out), versions.current(spark, warehouse_root(out)), FACT)
        exact = [f"{c} AS {kept}" for c, kept in cube.EXACT.items()]
        rows = delta.selectExpr(*cube.COLUMNS, *exact)
        rows = cut(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fact.drop("file_path").schema.fields]))
        keys = ["gid", *cube.KEYS]
        hits = fact.join(rows.select(*keys), keys, "left_semi")
        _rewritten(spark, out, FACT, hits, lambda old: loads.upsert_fact(old, rows, keys))


def delete_stored(spark: SparkSession, out: str, name: str, condition: Column) -> int:
    """Delete the rows of a stored dimension or of the fact for which the condition is true.

    Only files that hold such rows are written anew. Returns the number of those files.
    """
    table = versions.located(spark, warehouse_root(out), versions.current(spark, warehouse_root(out)), name)
    hits = table.where(condition)
    files = len(versions.files_of(hits, name))
    if files:
        with temporary_tables(spark):
            _rewritten(spark, out, name, hits, lambda old: loads.delete_where(old, condition))
    return files


def recluster_fact(spark: SparkSession, out: str) -> None:
    """Write the stored fact anew along the curve, as many increments leave many small files."""
    root = warehouse_root(out)
    before = versions.current(spark, root)
    new = _write_fact(versions.read(spark, root, before, FACT), root)
    _publish(spark, root, before, {FACT: new}, same_rows=True)


def run_status(spark: SparkSession, out: str) -> DataFrame:
    dw = read_warehouse(spark, out)
    return runlog.status_summary(
        read_log(spark, out), dw[FACT], dw["Dim_Cliente"], dw["Dim_Produto"]
    )
