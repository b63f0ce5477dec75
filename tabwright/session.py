"""A local session for tests and measurements; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "tabwright", warehouse: str | None = None) -> SparkSession:
    """``warehouse`` is where tables that jobs stage between steps go; the working folder's by default."""
    builder = SparkSession.builder if warehouse is None else SparkSession.builder.config("spark.sql.warehouse.dir", warehouse)
    spark = (
        builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Methods above this size are never compiled by the JVM's JIT.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
