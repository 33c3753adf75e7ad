"""A Spark session for one machine, used by the tests and the bench. Clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "eventide", memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
