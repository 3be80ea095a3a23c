from __future__ import annotations

import os

from pyspark.sql import SparkSession

from paneloom.runtime import SESSION_OPTIONS


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paneloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=SESSION_OPTIONS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
