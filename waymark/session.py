"""Session factory used by tests, the bench and scripts."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "waymark", master: str | None = None, **conf: str) -> SparkSession:
    """A local session: UTC, AQE on, few shuffle partitions, UI off.

    On a cluster the session comes from spark-submit; nothing in the library
    depends on the values set here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("WAYMARK_DRIVER_MEMORY", "8g"),
    } | conf
    spark = (
        SparkSession.builder.master(master or os.environ.get("WAYMARK_MASTER", "local[8]"))
        .appName(app)
        .config(map=settings)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
