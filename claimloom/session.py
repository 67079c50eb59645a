"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "claimloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests, benches and notebooks; a cluster passes its own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app)
        .master(master or f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CLAIMLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where none is set, a local one in local mode (tests) and an error on a cluster."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not hasattr(sc, "_claimloom_folder"):
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        sc._claimloom_folder = tempfile.mkdtemp(prefix="claimloom-")
        atexit.register(shutil.rmtree, sc._claimloom_folder, True)
    return sc._claimloom_folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(spark))


def checkpoint(df):
    """Cut lineage through the reliable checkpoint folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a session, for workers whose path lacks it."""
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_claimloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    # staged in the shared folder through its own file system
    place = f"{shared_folder(spark)}/claimloom_pkg_{sc.applicationId}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(place)
    sc._claimloom_shipped = True
