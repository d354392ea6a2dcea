"""Session settings, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None):
    """A session with the settings the operators are written for.

    Skew is handled where the plan shuffles: joins are split by AQE, exports go
    through a REBALANCE, which AQE also splits. On a cluster leave
    ``shuffle_partitions`` at a high number (a few per core over the largest
    shuffle / 128 MB); AQE merges what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="quotemill-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in one process may fall back to a temporary folder: executors of
    their own, as of ``local-cluster``, need one that they share.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    return _own_dir()


def _staging_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quotemill/{spark.conf.get('spark.app.id', 'session')}"


class Staging:
    """What is staged while a scope is open, and where its result goes."""

    def __init__(self, folder: str, outer: Staging | None):
        self.folder, self.outer = folder, outer

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written beyond this scope: to the one around it, or to the application's folder."""
        token = _SCOPE.set(self.outer)
        try:
            return staged(df, name)
        finally:
            _SCOPE.reset(token)


_SCOPE: contextvars.ContextVar[Staging | None] = contextvars.ContextVar("staging", default=None)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """A scope that owns what is staged within it, by jobs called there as well: it is deleted at the end.

    Write results before the scope is left, or ``keep`` them. Scopes nest; an inner one that
    fails takes what it staged with it. Each thread has scopes of its own.
    """
    outer = _SCOPE.get()
    scope = Staging(f"{outer.folder if outer else _staging_dir(spark)}/scope-{uuid.uuid4().hex}", outer)
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        _delete(spark, scope.folder)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new, unused path: in the folder of the open scope, or else of the application."""
    scope = _SCOPE.get()
    return f"{scope.folder if scope else _staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_staged(spark: SparkSession) -> None:
    """Delete what the application has staged. DataFrames that are still read from it are lost."""
    _delete(spark, _staging_dir(spark))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """The Parquet table at ``path``, or no rows if nothing was written there yet."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
