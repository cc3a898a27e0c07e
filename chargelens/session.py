"""Session settings for local runs; a cluster brings its own session."""

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, **settings):
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("chargelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
