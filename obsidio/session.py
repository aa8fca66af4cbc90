"""A session as the library expects it, and table loading."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "obsidio", **conf: str) -> SparkSession:
    """Sessions pin UTC and leave partition counts to adaptive execution."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor and the driver see, as ``spark.checkpoint.dir`` names it.

    Only on one machine a local folder is made and set where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="obsidio-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new place in the shared folder. All places of a session are deleted when the program ends."""
    root = f"{shared_folder(spark)}/obsidio/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_delete, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root)
    return f"{root}/{tag}-{uuid.uuid4().hex}"


_ROOTS: set[str] = set()


def _delete(jvm, conf, root: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)
