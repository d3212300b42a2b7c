"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that every plan of this package relies on. Sizes stay the cluster's own.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyweave")
    for key, value in CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one is set only in local mode where none is set."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyweave-checkpoint-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it again: an executor's loss never recomputes or loses it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def width(df: DataFrame) -> int:
    """Number of tasks that the cluster runs at once, from the session; never below the shuffle width."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a context, so that functions sent to them find it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallyweave-")) / "tallyweave.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    sc.addPyFile(str(archive))
    sc._tallyweave_shipped = True
