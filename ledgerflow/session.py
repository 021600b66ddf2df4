"""Session set-up and the one place that decides where reliable checkpoints go."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "ledgerflow", **conf: str) -> SparkSession:
    """Session for tests and the bench. On a cluster pass the submitted session instead."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
        # Let the JIT compile long generated methods (wide projections); on a cluster put the
        # same flag into spark.executor.extraJavaOptions.
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the one the cluster names, else a local one in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared checkpoint folder, so every reader sees the same rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
