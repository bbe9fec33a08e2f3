"""Tick input: stream and batch readers, parsing, dead letters, klines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.types import StructType

from ..functions.scalar import bytes_to_text
from ..functions.token import decode_token
from ..operators.bars import kline_volatility
from ..schemas import RAW_FIELDS, TICK_PAYLOAD

#: How the tick topic is read. Nothing caps a trigger, and messages the topic has dropped unread are an error.
STREAM_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "true"}


def stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
           schema: StructType | None = None, **options: str) -> DataFrame:
    """A stream of messages. For Kafka give ``kafka.bootstrap.servers`` and
    ``subscribe`` as options; file formats need ``path`` and ``schema`` and take
    ``maxFilesPerTrigger`` as their rate limit."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {**STREAM_OPTIONS, **options}
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def parse_payload(messages: DataFrame, value: str = "value", key: str | None = None) -> DataFrame:
    """Typed ticks from JSON payloads (tokens are opened when ``key`` is given).

    Numbers that do not parse become NULL; ticks without price or time are dropped.
    The test for them is part of the same expression: as a filter on its own it
    would be pushed below and parse every message again.
    """
    text = decode_token(value, key) if key else F.col(value).cast("string")

    def tick(d: Column) -> Column:
        return F.struct(
            F.timestamp_millis(d["event_time"]).alias("event_time"), d["trade_id"].alias("trade_id"),
            d["symbol"].alias("symbol"), d["price"].try_cast("double").alias("price"),
            d["quantity"].try_cast("double").alias("quantity"),
            F.coalesce(d["is_buyer_mm"], F.lit(False)).alias("is_buyer_mm"))

    usable = F.filter(F.transform(F.array(F.from_json(text, TICK_PAYLOAD)), tick),
                      lambda t: t["price"].isNotNull() & t["event_time"].isNotNull())
    return messages.select(F.inline(usable))


def checked(messages: DataFrame, value: str = "value") -> DataFrame:
    """Raw exchange messages with their parsed fields and an ``error`` if they are unusable."""
    text = bytes_to_text(value) if dict(messages.dtypes)[value] == "binary" else F.col(value)

    def judged(d: Column) -> Column:
        missing = F.array_compact(F.array(*[F.when(~F.map_contains_key(d, k), F.lit(k)) for k in RAW_FIELDS]))
        error = F.when(d.isNull(), F.lit("malformed JSON")).otherwise(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ","))))
        return F.struct(d.alias("d"), error.alias("error"))

    # as a map, because two of the keys differ in case only; parsed once for all uses
    parsed = F.array(F.from_json("raw", "map<string,string>"))
    return messages.withColumn("raw", text).select("*", F.inline(F.transform(parsed, judged)))


def good_ticks(messages: DataFrame) -> DataFrame:
    """Payload fields of the usable messages, renamed."""
    return messages.where("error IS NULL").select(
        *[F.col("d")[k].alias(v) for k, v in RAW_FIELDS.items()],
        F.coalesce(F.col("d")["m"].try_cast("boolean"), F.lit(False)).alias("is_buyer_mm"))


def dead_letters(messages: DataFrame) -> DataFrame:
    """``raw`` and ``error`` of the others."""
    return messages.where("error IS NOT NULL").select("raw", "error")


def payload_json(ticks: DataFrame) -> Column:
    """A tick as the JSON text put on the topic."""
    return F.to_json(F.struct(*[F.col(f.name) for f in TICK_PAYLOAD.fields if f.name in ticks.columns]))


def klines(batches: DataFrame, column: str = "klines") -> DataFrame:
    """Bars from JSON arrays of klines: fields by position 0 open time in ms, 1-4 prices,
    5 volume, 8 trades; each lasts a minute."""
    k = F.col("k")
    number = lambda i: F.get(k, F.lit(i)).try_cast("double")
    carried = [c for c in batches.columns if c != column]
    rows = batches.select(*carried, F.explode(F.from_json(column, "array<array<string>>")).alias("k"))
    start = F.timestamp_millis(F.get(k, F.lit(0)).try_cast("bigint"))
    return (rows.select(*carried, start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
                        number(1).alias("open"), number(2).alias("high"), number(3).alias("low"),
                        number(4).alias("close"), number(5).alias("volume"),
                        F.get(k, F.lit(8)).try_cast("int").alias("trade_count"))
            .withColumn("volatility", kline_volatility()))
