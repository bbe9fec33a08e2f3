"""Row types of the tables, and the row rules that go with them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
          "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType()}


def _type(name: str) -> T.DataType:
    if name.startswith("DECIMAL("):
        return T.DecimalType(*[int(n) for n in name[8:-1].split(",")])
    return _TYPES[name]


def _struct(columns: str) -> T.StructType:
    """Schema from "name TYPE, name TYPE"; needs no session, unlike ``fromDDL``."""
    return T.StructType([T.StructField(n, _type(k)) for n, k in (c.split() for c in columns.split(", "))])


#: Payload of one trade tick on the wire: numbers that need exactness travel as text.
TICK_PAYLOAD = _struct(
    "event_time BIGINT, symbol STRING, trade_id BIGINT, price STRING, quantity STRING, is_buyer_mm BOOLEAN")

#: One-letter key of a raw exchange message -> payload field; all five are required.
RAW_FIELDS = {"T": "event_time", "s": "symbol", "t": "trade_id", "p": "price", "q": "quantity"}

BARS = _struct(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, open DECIMAL(18,8), high DECIMAL(18,8), "
    "low DECIMAL(18,8), close DECIMAL(18,8), volume DECIMAL(24,8), trade_count INT, volatility DECIMAL(10,8)")

SENTIMENT = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, compound_score DECIMAL(6,4), positive_ratio DECIMAL(5,4), "
    "negative_ratio DECIMAL(5,4), neutral_ratio DECIMAL(5,4), weighted_compound DECIMAL(6,4), post_count INT, "
    "data_quality STRING, source_file STRING")

PREDICTIONS = _struct(
    "symbol STRING, window_start TIMESTAMP, predicted_vol DECIMAL(10,8), rolling_vol DECIMAL(10,8), "
    "price_range_ratio DECIMAL(8,6), vol_ratio DECIMAL(8,4), compound_score DECIMAL(6,4), "
    "minutes_since_sentiment DECIMAL(6,2), model_version STRING, inference_latency_ms INT")

RUNS = _struct(
    "run_id STRING, pipeline_name STRING, source STRING, target_table STRING, rows_processed BIGINT, "
    "rows_rejected BIGINT, quality_status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, params STRING")

APP_LOGS = _struct(
    "timestamp TIMESTAMP, service STRING, level STRING, message STRING, run_id STRING, extra STRING")

DATA_QUALITY = ("ok", "low_sample", "stale")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
AUDIT_OPERATIONS = ("INSERT", "UPDATE", "DELETE")

#: Model inputs, in the order the feature vector holds them.
FEATURES = ["rolling_vol", "price_range_ratio", "vol_ratio", "compound_score",
            "positive_ratio", "post_count", "minutes_since_sentiment"]
TARGET = "target_vol"


def bar_rules() -> dict[str, Column]:
    """Name -> condition every accepted bar fulfils (NULL counts as fulfilled)."""
    c = F.col
    return {
        "open_positive": c("open") > 0,
        "high_ge_open": c("high") >= c("open"),
        "low_le_open": (c("low") <= c("open")) & (c("low") > 0),
        "close_positive": c("close") > 0,
        "volume_not_negative": c("volume") >= 0,
        "trade_count_positive": c("trade_count") > 0,
        "volatility_not_negative": c("volatility") >= 0,
        "high_ge_low": c("high") >= c("low"),
    }


def sentiment_rules() -> dict[str, Column]:
    """Range and enumeration rules of a sentiment slot."""
    rules = {"compound_range": F.col("compound_score").between(-1, 1)}
    for name in ("positive_ratio", "negative_ratio", "neutral_ratio"):
        rules[f"{name}_range"] = F.col(name).between(0, 1)
    rules["post_count_not_negative"] = F.col("post_count") >= 0
    rules["data_quality_known"] = F.col("data_quality").isin(*DATA_QUALITY)
    return rules


def prediction_rules() -> dict[str, Column]:
    return {"predicted_not_negative": F.col("predicted_vol") >= 0}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to a table's column types; used just before a write.

    Columns the frame lacks become NULL. A number too wide for its DECIMAL fails
    the write rather than being stored as NULL.
    """
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
