"""Session for local runs; on a cluster the caller brings the session."""

from pyspark.sql import SparkSession


def local_session(
    cores: str = "8", memory: str = "8g", settings: dict[str, str] | None = None
) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("authlytics")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        # Room for the generated code of all queries of a run; the default keeps 100 classes.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config(map=settings or {})
        .getOrCreate()
    )
