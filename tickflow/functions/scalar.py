"""Scalar building blocks, all native expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.column import Column


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slot_start(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned ``width`` slot ``ts`` falls in ("30 minutes", "6 hours").

    Keeps the timestamp kind (zoned or not) of the input.
    """
    return F.window(col(ts), width).getField("start")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(col(a), col(b))


def minutes_between(earlier: Column | str, later: Column | str) -> Column:
    return F.timestamp_diff("SECOND", col(earlier), col(later)) / F.lit(60.0)


def age_minutes(ts: Column | str, as_of: Column) -> Column:
    return F.timestamp_diff("MINUTE", col(ts), as_of)


def hour_start(ts: Column | str) -> Column:
    return slot_start(ts, "1 hour")


def minute_start(ts: Column | str) -> Column:
    return slot_start(ts, "1 minute")


def json_field(text: Column | str, field: str) -> Column:
    return F.get_json_object(col(text), f"$.{field}")


def bytes_to_text(value: Column | str) -> Column:
    """Bytes as UTF-8; invalid sequences become the replacement character."""
    return F.make_valid_utf8(col(value).cast("string"))


def band(value: Column | str, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper limit lies above ``value``: a traffic light.

    ``band(x, [(50, "green"), (80, "amber")], "red")``. NULL stays NULL.
    """
    value = col(value)
    expr = None
    for limit, label in cuts:
        hit = value < F.lit(limit)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return F.when(value.isNotNull(), expr.otherwise(F.lit(otherwise)))


# Traffic-light limits.
CPU_BANDS = [(50, "green"), (80, "amber")]
MEMORY_BANDS = [(60, "green"), (85, "amber")]
DISK_BANDS = [(70, "green"), (90, "amber")]
AGE_BANDS = [(30, "green"), (120, "amber")]
COMPLETENESS_BANDS = [(95, "red"), (99, "amber")]
SENTIMENT_CUT = 0.05


def sentiment_sign(compound: Column | str) -> Column:
    c = col(compound)
    return (F.when(c > SENTIMENT_CUT, F.lit("positive"))
            .when(c < -SENTIMENT_CUT, F.lit("negative"))
            .when(c.isNotNull(), F.lit("neutral")))


def first_present(columns: list[str], names: list[str]) -> str | None:
    """First of ``names`` that exists; posts come with differing column names."""
    return next((n for n in names if n in columns), None)


def one_row(df) -> Column:
    """The single row of a global aggregate as a struct, for use in another frame.

    A scalar subquery: Spark computes the row once and every task gets its values.
    """
    return df.select(F.struct(*df.columns)).scalar()


def latest_instant(df, time: str) -> Column:
    """The highest ``time`` of ``df`` as a literal of the column's own type.

    Reports look back from here instead of from the clock; as a literal it lets
    the look-back filter reach the file scan.
    """
    kind = df.schema[time].dataType
    text = df.agg(F.max(time).cast("string")).first()[0]
    return F.lit(text).cast(kind)
