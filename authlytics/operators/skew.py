"""Joins in which frequent keys are spread over many tasks by an explicit salt.

Adaptive execution splits a partition only when it is large (256 MB by default).  Here the frequent
keys are found beforehand by a sketch of fixed size, whatever the number of rows or keys: their rows
are dealt to as many parts as they fill tasks, and the one row of the other side is copied to each.
Which keys the sketch finds changes where rows go, and never the result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 4096  # keys that a sketch holds, some 100 KB
HEAVY = 1024  # keys that are spread at most, so the table of them can always be broadcast
PARTS = 8  # of a key for each task that its rows would fill; fewer fall less evenly
_MERGED_IN = 256  # groups of sketches, merged side by side before the last merge


def heavy_keys(rows: DataFrame, key: str, tasks: int, parts: str) -> DataFrame:
    """(key, `parts`): keys with more rows than an even share of a task, at most HEAVY of them.

    A key with n times the even share is given PARTS * n parts.  Null is no key; without rows there is
    none.  The sketch errs by about one row in TRACKED, which is what keys of that share cost.
    """
    sketched = (
        rows.select(F.col(key).alias("item"))
        .filter(F.col("item").isNotNull())
        .withColumn("batch", F.spark_partition_id() % _MERGED_IN)
        .groupBy("batch")
        .agg(F.expr(f"approx_top_k_accumulate(item, {TRACKED})").alias("sketch"), F.count("*").alias("n"))
    )
    # Grouped, since without any sketch there is none to combine.
    counted = sketched.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {TRACKED}), {HEAVY})").alias("top"),
        F.sum("n").alias("n"),
    )
    share = F.col("found.count") * tasks / F.col("n")
    return (
        counted.select("n", F.explode("top").alias("found"))
        .filter(share > 1)
        .select(F.col("found.item").alias(key), F.ceil(PARTS * share).cast("int").alias(parts))
    )


def is_broadcast(rows: DataFrame) -> bool:
    """Whether Spark, by its own estimate of the size, would send the rows to every executor."""
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit


def spread_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`many.join(few, key, how)`, inner or left, with frequent keys of `many` spread over tasks.

    A table that Spark broadcasts is joined as it is.  Otherwise the rows of a frequent key, and of
    null in a left join, are dealt to parts by their place in `many`, which should come from a scan
    so that a task that runs again deals them alike.  The sketch reads the key of `many` once more.
    Columns other than the key must have different names on both sides; they come as in the plain
    join.  Rows repeated on either side are joined as often as there.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join knows inner and left joins, not {how}")
    if is_broadcast(few):
        return many.join(few, key, how)
    taken = {c.lower() for c in (*many.columns, *few.columns)}
    parts, salt = "parts", "salt"
    while {parts, salt} & taken:
        parts, salt = f"{parts}_", f"{salt}_"
    tasks = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(many, key, tasks, parts))
    into = F.coalesce(F.col(parts), F.when(F.col(key).isNull(), PARTS * tasks).otherwise(1))
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = (
        many.withColumn(salt, place)
        .join(heavy, key, "left")
        .withColumn(salt, F.pmod(F.col(salt), into).cast("int"))
    )
    last = F.coalesce(F.col(parts), F.lit(1)) - 1
    copied = few.join(heavy, key, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), last))
    )
    joined = dealt.drop(parts).join(copied.drop(parts), [key, salt], how)
    others = [c for c in (*many.columns, *few.columns) if c != key]
    return joined.select(key, *others)
