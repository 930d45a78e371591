"""The local session tests and scripts share."""

import tempfile

from pyspark.sql import SparkSession


def session(partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("ratescope")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ratescope-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
