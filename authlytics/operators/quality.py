"""Data-quality operators.

Each check has a failing-row form; `check_all` counts the failures of many checks together.
"""

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.functions import columns as c
from authlytics.schemas import DQ_SUMMARY


def _check_time(as_of: datetime | None) -> Column:
    # As text: a datetime literal would pass through the session time zone.
    return F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")


def _check_day(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


# -- failing rows -------------------------------------------------------------------


def not_null(relation: DataFrame, column: str) -> DataFrame:
    """Rows without a value in the column."""
    return relation.filter(F.col(column).isNull())


def unique(relation: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return (
        relation.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


PLACES = 1 << 26  # of the bitmap: 8 MB, whatever the number of rows
_BUCKET_BITS = 32768  # of one row of bitmap_construct_agg


def repeated_places(relation: DataFrame, column: str, places: int = PLACES) -> DataFrame:
    """(bucket, bits): the places, hashes of the values modulo `places`, that occur twice.

    Rows are counted by place, a number of four bytes; the bitmap has a fixed size.
    """
    place = F.pmod(F.xxhash64(column), F.lit(places)).cast("int")
    counted = (
        relation.filter(F.col(column).isNotNull())
        .groupBy(place.alias("place"))
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place"))
    return counted.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(bits.alias("bits"))


def may_repeat(
    relation: DataFrame, column: str, repeated: DataFrame, places: int = PLACES
) -> DataFrame:
    """The rows whose place is in a bitmap of `repeated_places`: all that share their value with
    another row, and few others until the bitmap fills up."""
    place = F.pmod(F.xxhash64(column), F.lit(places))
    position = F.bitmap_bit_position(place)
    byte = F.expr("cast(conv(hex(substring(bits, (position >> 3) + 1, 1)), 16, 10) as int)")
    marked = (
        relation.select(F.col(column))
        .withColumns({"bucket": F.bitmap_bucket_number(place), "position": position.cast("int")})
        # places / 32768 rows of 4 KB at most.
        .join(F.broadcast(repeated), "bucket")
        .filter(byte.bitwiseAND(F.expr("1 << (position & 7)")) != 0)
    )
    return marked.select(column)


def unique_in_two_passes(relation: DataFrame, column: str, places: int = PLACES) -> DataFrame:
    """`unique`, for relations so large that their values are worth not shuffling.

    The first pass finds the places that occur twice, the second counts only the values at such
    places.  A bitmap that is full lets every value through, so it changes no result.
    """
    repeated = repeated_places(relation, column, places)
    return unique(may_repeat(relation, column, repeated, places), column)


def accepted_values(relation: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the list; nulls are never reported."""
    return (
        relation.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def future_events(events: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Events later than the check time (default: now)."""
    check_ts = _check_time(as_of)
    return events.filter(F.col("event_ts") > check_ts).select(
        "event_id", "event_ts", check_ts.alias("check_ts")
    )


def low_conversion(
    fct: DataFrame, as_of: date | None = None, threshold: float = 0.10
) -> DataFrame:
    """Days of the last seven whose average slice conversion is below the threshold."""
    first_day = F.date_sub(_check_day(as_of), 7).cast("timestamp_ntz")
    recent = (F.col("metric_date") >= first_day) & F.col("login_conversion_rate").isNotNull()
    return (
        fct.filter(recent)
        .groupBy("metric_date")
        .agg(F.avg("login_conversion_rate").alias("conversion"))
        .filter(F.col("conversion") < threshold)
        .select("metric_date", c.rounded(F.col("conversion"), 4).alias("avg_daily_conversion"))
    )


def _verdicts() -> dict[str, Column]:
    return {"should_warn": F.col("failures") != 0, "should_error": F.col("failures") != 0}


def summary(failing_rows: DataFrame) -> DataFrame:
    """One row: the number of failing rows, and whether they should warn or fail."""
    return failing_rows.agg(F.count("*").alias("failures")).withColumns(_verdicts())


# -- many checks at once ------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A declared check; `kind` names the operator above that defines its failing rows."""

    relation: str
    column: str
    kind: str
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.relation}.{self.column}.{self.kind}"

    def measure_name(self, value: str) -> str:
        """Names the check together with the rule it was measured by, so that a measure is not
        taken for that of a later rule."""
        return f"{self.name} {value} {' '.join(self.values)}".strip()


def measure(check: Check, value: str, usable: str = "true") -> dict[str, Column]:
    """The check as an aggregate that can be observed while a table is written, by name.

    `value` is the checked column as an expression over the written rows, of which those count that
    are `usable`.  Uniqueness and averages have no such aggregate: nothing for them.
    """
    rows, checked = F.expr(usable), F.expr(value)
    if check.kind == "not_null":
        found = c.count_where(rows & checked.isNull())
    elif check.kind == "accepted_values":
        found = c.count_where(rows & ~checked.isin(*check.values))
    elif check.kind == "future_events":
        found = F.max(F.when(rows, checked)).cast("string")
    else:
        return {}
    return {check.measure_name(value): found}


def settled(check: Check, found: object, as_of: str) -> int | None:
    """The failures of a check, where its measure tells them; a table without rows measures null."""
    if not found:
        return 0
    if check.kind == "not_null":
        return int(found)
    # How many different values, or which rows, only the relation itself tells.
    return 0 if check.kind == "future_events" and str(found) <= as_of else None


def _row_condition(check: Check, as_of: datetime | None) -> Column:
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "future_events":
        return value > _check_time(as_of)
    raise ValueError(f"unknown check kind: {check.kind}")


def _one_row_per_check(counted: DataFrame, checks: list[Check]) -> DataFrame:
    """Turn one row with a column per check into (check_name, failures) rows."""
    results = [
        F.struct(F.lit(check.name).alias("check_name"), F.col(str(i)).alias("failures"))
        for i, check in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*results)))


def _count_rows_and_values(
    relation: DataFrame, checks: list[Check], as_of: datetime | None
) -> DataFrame:
    """Row checks and accepted values of one relation in one scan.

    Rows are first grouped by their unaccepted values, null for a clean row, so that clean
    data shuffles one row per task; repeated bad values are combined before the shuffle.
    """
    first, second, bad_values = [], [], []
    for i, check in enumerate(checks):
        if check.kind == "accepted_values":
            value = F.col(check.column)
            bad_values.append(F.when(~value.isin(*check.values), value).alias(str(i)))
            second.append(F.count_distinct(str(i)).alias(str(i)))
        else:
            first.append(c.count_where(_row_condition(check, as_of)).alias(str(i)))
            second.append(F.coalesce(F.sum(str(i)), F.lit(0)).alias(str(i)))
    if bad_values:
        relation = relation.groupBy(*bad_values).agg(F.count("*").alias("rows"), *first)
    else:
        relation = relation.agg(*first)
    return _one_row_per_check(relation.agg(*second), checks)


def _count_repeated(relation: DataFrame, check: Check, two_passes: bool) -> DataFrame:
    repeated = (unique_in_two_passes if two_passes else unique)(relation, check.column)
    return _one_row_per_check(repeated.agg(F.count("*").alias("0")), [check])


def check_all(
    relations: dict[str, DataFrame],
    checks: list[Check],
    as_of: datetime | None = None,
    failures: dict[str, int] | None = None,
    two_passes: bool = False,
) -> DataFrame:
    """Failures of every check, one row each.

    `failures` are those that are known already, by check.  Every other check reads the relation it
    names: row checks and accepted values in one scan per relation, unique keys in one shuffle of
    the key each.
    """
    day = None if as_of is None else as_of.date()
    failures = failures or {}
    row_checks: dict[str, list[Check]] = {}
    counted = []
    for check in checks:
        if check.name in failures:
            continue
        if check.kind == "low_conversion":
            days = low_conversion(relations[check.relation], day)
            counted.append(_one_row_per_check(days.agg(F.count("*").alias("0")), [check]))
        elif check.kind == "unique":
            counted.append(_count_repeated(relations[check.relation], check, two_passes))
        else:
            row_checks.setdefault(check.relation, []).append(check)
    for name, mine in row_checks.items():
        counted.append(_count_rows_and_values(relations[name], mine, as_of))
    if failures:
        spark = next(iter(relations.values())).sparkSession
        known = [(check.name, failures[check.name]) for check in checks if check.name in failures]
        counted.append(spark.createDataFrame(known, "check_name string, failures long"))
    found = reduce(DataFrame.unionByName, counted)
    return found.withColumns(_verdicts()).select(*DQ_SUMMARY.names)
