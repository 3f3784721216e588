"""Values of a PostgreSQL change feed or copy, as text or in binary, decoded to the same types."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import hinted

#: The hint of each type of the database, by its name (fixed values). numeric takes its precision and scale as decimal(p,s).
HINT = {"int2": "int64", "int4": "int64", "int8": "int64", "text": "utf8", "varchar": "utf8", "bpchar": "utf8", "uuid": "uuid", "json": "json", "jsonb": "json", "date": "date", "time": "time", "timestamp": "timestamp", "timestamptz": "timestamp_tz"}
#: Days and microseconds from 1970-01-01 to 2000-01-01, where the binary forms begin (fixed values).
DAYS, MICROS = 10_957, 946_684_800_000_000


def decode_text(value: Column, kind: str) -> Column:
    """A value from its text form; null stays null, and a text that isn't one of the type fails."""
    if kind == "bool":
        return hinted(F.when(value == "t", "true").when(value == "f", "false").otherwise(value), "bool")
    if kind == "bytea":
        bad = F.raise_error(F.concat(value, F.lit(" isn't bytea"))).cast("binary")
        return F.when(value.isNull(), F.lit(None).cast("binary")).when(value.rlike(r"^\\x([0-9a-fA-F]{2})*$"), F.unhex(F.substring(value, 3, 1 << 30))).otherwise(bad)
    if kind in ("float4", "float8"):  # the one place where no number and infinity are values
        plain = F.when(value.isin("NaN", "Infinity", "-Infinity"), value.cast("double"))
        return F.coalesce(plain, hinted(F.when(plain.isNull(), value), "float64"))
    if kind in ("timestamp", "timestamptz", "date"):
        never = F.when(value.rlike("infinity|BC$"), F.raise_error(F.concat(value, F.lit(" has no place in the calendar"))).cast("string"))
        return hinted(F.coalesce(never, value), HINT[kind])
    if kind not in HINT and not kind.startswith("decimal"):
        raise ValueError(f"values of {kind} aren't read")
    return hinted(value, HINT.get(kind, kind))


def whole(data: Column, size: int) -> Column:
    """The signed number in size bytes, the highest first; other lengths fail."""
    bits = 8 * size
    hexed = F.hex(data)
    unsigned = F.conv(hexed, 16, 10).cast("decimal(20,0)")
    signed = F.when(unsigned >= F.lit(str(1 << (bits - 1))).cast("decimal(20,0)"), unsigned - F.lit(str(1 << bits)).cast("decimal(21,0)")).otherwise(unsigned).cast("long")
    bad = F.raise_error(F.concat(F.lit(f"{size} bytes are needed, not "), F.length(data).cast("string"))).cast("long")
    return F.when(data.isNull(), F.lit(None).cast("long")).when(F.length(data) == size, signed).otherwise(bad)


def real(data: Column, size: int) -> Column:
    """The floating-point number in 4 or 8 bytes."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        if wrong := next((v for v in values if v is not None and len(v) != size), None):
            raise ValueError(f"{size} bytes are needed, not {len(wrong)}")
        there = values.notna().to_numpy()
        out = np.full(len(values), np.nan)
        out[there] = np.frombuffer(b"".join(values[there]), dtype=f">f{size}")
        return pd.Series(out).where(there)

    return F.when(data.isNull(), F.lit(None).cast("double")).otherwise(run(data))


def decode_binary(value: Column, kind: str) -> Column:
    """A value from its binary form: dates and times begin at 2000-01-01 there."""
    if kind == "bool":
        return whole(value, 1) != 0
    if kind in ("int2", "int4", "int8"):
        return whole(value, int(kind[3:]))
    if kind in ("float4", "float8"):
        return real(value, int(kind[5:]))
    if kind in ("text", "varchar", "bpchar", "json"):
        return F.decode(value, "UTF-8")
    if kind == "jsonb":  # a version byte goes before the text
        return F.when(F.hex(F.substring(value, 1, 1)) == "01", F.decode(F.substring(value, 2, 1 << 30), "UTF-8")).when(value.isNotNull(), F.raise_error(F.lit("an unknown version of jsonb")).cast("string"))
    if kind == "bytea":
        return value
    if kind == "uuid":
        return F.regexp_replace(F.lower(F.hex(value)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    if kind == "date":
        return F.date_from_unix_date((whole(value, 4) + DAYS).cast("int"))
    if kind == "time":
        return whole(value, 8)
    if kind in ("timestamp", "timestamptz"):
        at = F.timestamp_micros(whole(value, 8) + MICROS)
        return at if kind == "timestamptz" else F.to_utc_timestamp(F.from_utc_timestamp(at, "UTC"), "UTC").cast(T.TimestampNTZType())
    raise ValueError(f"values of {kind} aren't read in binary")
