"""Session settings, shared-folder checkpoints and table access."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = "*", app: str = "quirework", **conf: str) -> SparkSession:
    """A local session with the settings the engine assumes (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset and the
    master is local (a test session) a temporary folder of this machine is made.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quirework-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage through the shared folder.

    Used where one intermediate result feeds several stages. The copy is in the
    folder all executors share, so a lost executor does not lose it.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work in Python.

    Few small files make few partitions; only then are the rows dealt out anew. A
    table of many partitions is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``folder/name.parquet``."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def row_count_at_most(df: DataFrame, bound: int) -> list | None:
    """The rows of ``df`` if there are at most ``bound``, else None.

    The check that stands before every table sent to all executors: at most
    ``bound + 1`` rows ever reach the driver.
    """
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, so that their functions load wherever they were started.

    Once per application; the archive is named by its content and served by the driver.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(root):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    with open(path, "rb") as f:
                        z.writestr(zipfile.ZipInfo(os.path.join(os.path.basename(root), os.path.relpath(path, root))), f.read())
    name = f"quirework-{hashlib.sha256(data.getvalue()).hexdigest()[:12]}.zip"
    # the driver serves the file as long as the application runs
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ""
    folder = shared.removeprefix("file://") if shared.startswith(("/", "file:///")) else tempfile.mkdtemp(prefix="quirework-")
    if not shared:
        atexit.register(shutil.rmtree, folder, True)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    if not os.path.exists(path):
        with open(f"{path}.{os.getpid()}", "wb") as f:
            f.write(data.getvalue())
        os.replace(f"{path}.{os.getpid()}", path)
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
