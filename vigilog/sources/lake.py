"""Where the zones live, how tables are written and read, and the SQL views over them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigilog.functions.columns import calendar_day
from vigilog.sources.schemas import AUTH_RAW, AUTH_SILVER

DAY_PARTITION = "jour_part"
# Rows per file of a table laid out by day: about 30 MB of compressed log.
FILE_ROWS = 2_000_000
SILVER_TABLE = "auth_silver"
LANDED_TABLE = "auth_brut"
ATTACK_TABLE = "redteam"
# Names that readers of the lake rely on.
GOLD_TABLES = (
    "connexions_par_utilisateur_heure",
    "activite_par_machine",
    "anomalies_horaires",
    "taux_echec_par_utilisateur",
    "machines_distinctes_par_utilisateur",
    "volume_par_jour",
    "paires_rares_utilisateur_machine",
    "validation_redteam",
)
COMPARISON_TABLE = "comparaison_criteres_detection"


class Lake:
    """Paths of one lake, below any base URI Spark can write (file:, s3a:, hdfs:).

    Gold tables are published in versions; `read_gold` finds the current one.
    """

    VERSIONS = "gold/versions"

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def landed(self) -> str:
        return f"{self.base}/bronze_parquet/{LANDED_TABLE}.parquet"

    def attacks(self) -> str:
        return f"{self.base}/bronze_parquet/{ATTACK_TABLE}.parquet"

    def silver(self) -> str:
        return f"{self.base}/silver/{SILVER_TABLE}.parquet"

    def pairs(self) -> str:
        """Intermediate table of the Gold job: one row per (user, destination, category)."""
        return f"{self.base}/travail/paires.parquet"

    def state(self, name: str) -> str:
        """Partial aggregates of the Gold tables, kept by day."""
        return f"{self.base}/travail/etats/{name}.parquet"

    def manifest(self) -> str:
        """The raw objects landed so far."""
        return f"{self.base}/travail/manifeste.parquet"

    def reading(self) -> str:
        """Lines of a tolerant read, before they are parted."""
        return f"{self.base}/travail/lecture.parquet"

    def rejects(self) -> str:
        return f"{self.base}/bronze_parquet/rejets.parquet"

    def delivery(self) -> str:
        """The lines of the latest delivery of new days."""
        return f"{self.base}/travail/livraison.parquet"

    def pointers(self) -> str:
        """Which version of each Gold table is the current one."""
        return f"{self.base}/gold/pointeurs.parquet"

    def report(self, name: str) -> str:
        return f"{self.base}/rapports/{name}.parquet"


@lru_cache(maxsize=None)
def _local_base(application: str) -> str:
    """A folder of this process for a local session, removed when the process ends."""
    base = tempfile.mkdtemp(prefix=f"vigilog-{application}-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_base(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A folder set for the session wins over one set when it started. Only a local session
    that names none gets a folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_base(context.applicationId)


def scratch_path(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A new folder for an intermediate table.

    Everything a session writes lies below one folder, ``vigilog-<application id>``, in
    ``base`` or in the session's shared folder. Results read from there stay valid until
    that folder is deleted, which is the owner's to do once the session has ended; within a
    `scratch_scope` the folder is deleted with it.
    """
    base = (base or scratch_base(spark)).rstrip("/")
    path = f"{base}/vigilog-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].append(path)
    return path


# Paths handed out in each open scope, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made in a block when it is left.

    Whatever is read of them has to be done by then: write what is to stay to a path taken
    before the block.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        discard(spark, paths)


def discard(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Delete folders or files through the file system that Spark writes with; returns those that were there."""
    java, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = []
    for path in sorted(paths):
        target = java.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(settings).delete(target, True):
            gone.append(path)
    return gone


def write_table(df: DataFrame, path: str, compression: str | None = "zstd") -> None:
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def write_all(tables: dict[str, DataFrame], at_once: int = 4) -> None:
    """Write independent tables (path -> rows) together, so one table's last, narrow
    stages do not leave the cluster idle. The first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        for _ in pool.map(lambda path: write_table(tables[path], path), tables):
            pass


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once and continue from the files, for results that several jobs reuse."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_by_day(df: DataFrame, path: str, file_rows: int = FILE_ROWS, replace_days: bool = False) -> None:
    """Lay a table out by true day, so that joins on a second read only its day.

    Rows not yet dated are gathered by day and by runs of ``file_rows`` rows in the order
    they were read, so a day is cut in pieces however few files it came from: one gzip
    file is read by a single task, whose output for one key AQE could not cut. Rows read
    from such a layout carry their day and are written as they come, without
    another shuffle. No file holds more than ``file_rows`` rows. With ``replace_days`` only the
    days that ``df`` holds are replaced, and the others are left as they are.
    """
    if DAY_PARTITION not in df.columns:
        run = F.floor(F.monotonically_increasing_id() / F.lit(file_rows))
        dated = df.withColumn(DAY_PARTITION, calendar_day(F.col("temps_secondes"))).withColumn("_run", run)
        df = dated.hint("rebalance", F.col(DAY_PARTITION), F.col("_run")).drop("_run")
    writer = df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", file_rows)
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace_days else "static")
    writer.partitionBy(DAY_PARTITION).parquet(path)


def _read_by_day(spark: SparkSession, path: str, schema: StructType, with_day: bool) -> DataFrame:
    df = spark.read.parquet(path)
    names = list(schema.names)
    if with_day and DAY_PARTITION in df.columns:
        names.append(DAY_PARTITION)
    return df.select(*names)


def read_landed(spark: SparkSession, path: str, with_day: bool = False) -> DataFrame:
    """The nine raw columns; ``with_day`` adds the layout column where it exists."""
    return _read_by_day(spark, path, AUTH_RAW, with_day)


def read_silver(spark: SparkSession, path: str, with_day: bool = False) -> DataFrame:
    """The eleven cleaned columns; ``with_day`` adds the layout column where it exists."""
    return _read_by_day(spark, path, AUTH_SILVER, with_day)


POINTER = "numero bigint, table string, chemin string"


def pointers(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Every version of every published table; None before the first one."""
    return _read_if_written(spark, lake.pointers(), POINTER)


def current_paths(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """Where the current version of each published table lies."""
    known = pointers(spark, lake)
    if known is None:
        return {}
    latest = known.groupBy("table").agg(F.max(F.struct("numero", "chemin")).alias("latest"))
    return {name: f"{lake.base}/{path}" for name, path in latest.select("table", "latest.chemin").collect()}


def read_gold(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The current version of a published table."""
    path = current_paths(spark, lake).get(table)
    if path is None:
        raise LookupError(f"{table} has not been published in {lake.base}")
    return spark.read.parquet(path)


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views for SQL users: raw copies, cleaned table and every Gold table.

    Tables not written yet are skipped. Returns the names registered.
    """
    published = current_paths(spark, lake)
    paths = {LANDED_TABLE: lake.landed(), ATTACK_TABLE: lake.attacks(), SILVER_TABLE: lake.silver()}
    paths.update({name: published[name] for name in (*GOLD_TABLES, COMPARISON_TABLE) if name in published})
    views = {name: _read_if_written(spark, path) for name, path in paths.items()}
    for name, schema in ((LANDED_TABLE, AUTH_RAW), (SILVER_TABLE, AUTH_SILVER)):
        if views[name] is not None:
            views[name] = views[name].select(*schema.names)
    registered = []
    for name, df in views.items():
        if df is not None:
            df.createOrReplaceTempView(name)
            registered.append(name)
    return sorted(registered)


def _read_if_written(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
