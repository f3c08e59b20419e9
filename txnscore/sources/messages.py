"""Message encoding and decoding.

A message is ``key, value``: the key is the transaction number as text and
the value a JSON object of the transaction with the event time as text. The
same two columns are what a Kafka record carries, so ``publish`` can target a
Kafka topic (``format("kafka")``) or a file log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_time, time_text
from ..schemas import EVENT_TIME, KEY, TXN


def encode_messages(df: DataFrame, key: str = KEY, id_col: str | None = None,
                    time_col: str = EVENT_TIME) -> DataFrame:
    """(key, value) per row. The key is ``key`` when that column exists,
    else ``id_col`` (a stable id the caller supplies)."""
    if key in df.columns:
        k = F.col(key).cast("string")
    elif id_col is not None:
        k = F.col(id_col).cast("string")
    else:
        raise ValueError(f"no key column {key!r} and no id column given")
    fields = [time_text(c).alias(c) if c == time_col else F.col(c) for c in df.columns]
    return df.select(k.alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def decode_messages(df: DataFrame, schema: T.StructType = TXN, time_col: str = EVENT_TIME,
                    keep_key: bool = False, keep_value: bool = False) -> DataFrame:
    """Typed rows from (key, value). Malformed JSON gives all-NULL fields
    (route those through ``reject_rows``); bare ``NaN`` is accepted."""
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType()) if f.name == time_col else f
        for f in schema.fields])
    parsed = F.from_json(F.col("value").cast("string"), text_schema,
                         {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})
    out = df.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("_key"),
                    F.col("value").cast("string").alias("_value"), parsed.alias("_m"))
    cols = []
    for f in schema.fields:
        c = F.col(f"_m.{f.name}")
        if f.name == time_col:
            c = parse_time(c).cast(f.dataType)
        cols.append(c.alias(f.name))
    extra = ([F.col("_key").alias("key")] if keep_key else []) + \
            ([F.col("_value").alias("value")] if keep_value else [])
    return out.select(*extra, *cols)


def publish(messages: DataFrame, fmt: str = "parquet", path: str | None = None,
            options: dict | None = None, mode: str = "append") -> None:
    """Write messages to a log: ``kafka`` (needs the Kafka connector on the
    classpath, ``topic`` and ``kafka.bootstrap.servers`` in ``options``) or a
    file format at ``path``."""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode(mode).save(path)


# JSON types (as ``schema_of_variant`` names them) that a number column takes.
_NUMBER = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _field_reason(kind: Column, value: Column, f: T.StructField, required: bool, time_col: str) -> Column:
    """Why one field of a parsed message cannot be taken (NULL: it can), from its
    JSON type (NULL: not there) and its value."""
    if f.name == time_col or isinstance(f.dataType, T.StringType):
        good = (kind == "STRING") & value.isNotNull()
    elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        odd = F.isnan(value) | (F.abs(value) == float("inf"))
        good = kind.rlike(_NUMBER) | ((kind == "STRING") & F.coalesce(odd, F.lit(False)))
    elif isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
        good = (kind == "BIGINT") & value.isNotNull()
    else:
        good = value.isNotNull()
    missing = F.lit(f"missing:{f.name}") if required else F.lit(None).cast("string")
    return F.when(kind.isNull(), missing).when((kind != "VOID") & ~good, F.lit(f"type:{f.name}"))


def decode_checked(df: DataFrame, schema: T.StructType = TXN, time_col: str = EVENT_TIME,
                   required: Sequence[str] | None = None) -> DataFrame:
    """key, value, ``reason`` and the typed columns of every message.

    ``reason`` is NULL for a message that can be taken whole, else the first of
    ``no_value``, ``bad_json`` (cut off, or no JSON), ``not_object``, or all of
    ``missing:<field>`` (of the ``required`` ones, by default the key and the time) and
    ``type:<field>`` (another JSON type, an unreadable time, an integer out of
    range), in field order. A JSON null is a NULL; a bare or quoted NaN is a number."""
    required = (KEY, time_col) if required is None else required
    text = F.col("value").cast("string")
    # bare NaN is what some writers send; JSON knows it as text only
    quoted = F.regexp_replace(text, r"(:\s*)(NaN|-?Infinity)(\s*[,}])", r'$1"$2"$3')
    v, out = F.col("_v"), []
    for f in schema.fields:
        kind = F.when(F.col("_kind").startswith("OBJECT"), F.schema_of_variant(F.variant_get(v, f"$.{f.name}", "variant")))
        value = F.try_variant_get(v, f"$.{f.name}", "string" if f.name == time_col else f.dataType.simpleString())
        out += [kind.alias(f"_kind_{f.name}"), (parse_time(value).cast(f.dataType) if f.name == time_col else value).alias(f.name)]
    rows = (df.select(F.col("key").cast("string").alias("key"), text.alias("value"), F.try_parse_json(quoted).alias("_v"))
            .select("key", "value", "_v", F.schema_of_variant("_v").alias("_kind")))
    # one row in, one row out: a filter on the reason is not pushed below this, which would parse every message again
    rows = rows.select("key", "value", "_kind", F.explode(F.array(F.struct(*out))).alias("_m")).select("key", "value", "_kind", "_m.*")
    fields = F.concat_ws(",", *[_field_reason(F.col(f"_kind_{f.name}"), F.col(f.name), f, f.name in required, time_col)
                                for f in schema.fields])
    rows = rows.withColumn("_fields", fields)
    reason = (F.when(F.col("value").isNull(), "no_value").when(F.col("_kind").isNull(), "bad_json")
              .when(~F.col("_kind").startswith("OBJECT"), "not_object").when(F.col("_fields") != "", F.col("_fields")))
    return rows.select("key", "value", reason.alias("reason"), *schema.fieldNames())


def split_decoded(df: DataFrame, schema: T.StructType = TXN, time_col: str = EVENT_TIME,
                  required: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects): rejects keep key and value and say why. Together they
    are the input, message by message."""
    out = decode_checked(df, schema, time_col, required)
    good = out.where(F.col("reason").isNull()).select(*schema.fieldNames())
    return good, out.where(F.col("reason").isNotNull()).select("key", "value", "reason")
