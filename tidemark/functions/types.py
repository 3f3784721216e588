"""Logical types: hints, strict decimals, the shapes of CSV columns, and which changes of a type are allowed."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

#: Hints by name; Spark's time type is off by default, so a time of day is microseconds.
HINTS: dict[str, T.DataType] = {
    "bool": T.BooleanType(), "int64": T.LongType(), "float64": T.DoubleType(), "utf8": T.StringType(), "timestamp_tz": T.TimestampType(),
    "timestamp": T.TimestampNTZType(), "date": T.DateType(), "time": T.LongType(), "uuid": T.StringType(), "json": T.StringType(), "binary": T.BinaryType(),
}


def hint_type(hint: str) -> T.DataType:
    """The type of a hint; decimal(p,s) is one too."""
    if hint.startswith("decimal"):
        return T.DataType.fromDDL(hint)
    if hint not in HINTS:
        raise ValueError(f"no type hint {hint}; known: {', '.join(HINTS)}, decimal(p,s)")
    return HINTS[hint]


def canonical(kind: T.DataType) -> T.DataType:
    """The engine's type of a source type: integers are long, floats double, nested values text."""
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(kind, (T.VarcharType, T.CharType, T.MapType)):
        return T.StringType()
    return kind


def ingest(df: DataFrame) -> DataFrame:
    """df in the engine's types; maps become JSON text, announced once a column."""
    out = []
    for f in df.schema.fields:
        to = canonical(f.dataType)
        if isinstance(f.dataType, T.MapType):
            log.warning("column %s travels as text", f.name)
            out.append(F.to_json(f"`{f.name}`").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`").cast(to).alias(f.name))
    return df.select(*out)


#: Families of types a database source may be hinted to; text always is allowed.
ALLOWED = {
    "long": {"int64", "decimal", "float64"}, "double": {"float64"}, "decimal": {"decimal", "float64", "int64"}, "boolean": {"bool"},
    "string": {"decimal", "json", "uuid", "timestamp", "timestamp_tz", "date"}, "timestamp": {"timestamp_tz", "date"}, "timestamp_ntz": {"timestamp", "date"}, "date": {"date", "timestamp"}, "binary": {"binary"},
}


def apply_hints(df: DataFrame, hints: dict[str, str]) -> DataFrame:
    """Cast hinted columns; pairs that aren't allowed are refused before anything is read, and casts never lose digits or guess."""
    for name, hint in hints.items():
        if name not in df.columns:
            raise ValueError(f"hint for {name}, which isn't a column")
        family = canonical(df.schema[name].dataType).typeName()
        if hint != "utf8" and hint.split("(")[0] not in ALLOWED.get(family, set()):
            raise ValueError(f"column {name} of type {family} can't be hinted {hint}")
        to = hint_type(hint)
        df = df.withColumn(name, strict_decimal(F.col(name), to.precision, to.scale) if isinstance(to, T.DecimalType) else F.col(name).cast(to))
    return df


def hinted(cell: Column, hint: str, where: Column | None = None) -> Column:
    """A cell of text in the type of a hint. What doesn't fit fails, with where before the value; nothing is guessed or rounded."""
    where = F.lit("") if where is None else where
    kind = hint_type(hint)
    plain = F.trim(cell)
    number = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    if hint == "utf8":
        return cell
    if isinstance(kind, T.DecimalType):
        value, fits = plain.try_cast(kind), ~loses_digits(cell, kind.precision, kind.scale)
    elif hint == "uuid":
        value, fits = F.lower(plain), plain.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
    elif hint == "json":
        value, fits = cell, F.try_parse_json(cell).isNotNull()
    elif hint == "time":  # microseconds of the day
        part = lambda k: F.regexp_extract(plain, r"^(\d{2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?$", k)
        whole = lambda k: F.coalesce(part(k).try_cast("long"), F.lit(0))
        value = ((whole(1) * 60 + whole(2)) * 60 + whole(3)) * 1_000_000 + F.rpad(F.coalesce(part(4), F.lit("")), 6, "0").cast("long")
        fits = plain.rlike(r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?$")
    elif hint == "binary":
        value, fits = F.unhex(plain), plain.rlike(r"^([0-9a-fA-F]{2})*$")
    elif hint == "int64":
        value, fits = F.regexp_replace(plain, r"^\+", "").try_cast("bigint"), plain.rlike(r"^[+-]?\d+$")
    elif hint == "float64":
        value, fits = plain.try_cast("double"), plain.rlike(number)
        fits = fits & (F.abs(value) < float("inf"))
    elif hint == "bool":
        value, fits = plain == "true", plain.isin("true", "false")
    else:
        value, fits = plain.try_cast(kind), F.lit(True)
    fits = F.coalesce(fits & value.isNotNull(), F.lit(False))
    bad = F.raise_error(F.concat(where, cell, F.lit(f" isn't {hint}"))).cast(kind)
    return F.when(cell.isNull(), F.lit(None).cast(kind)).when(fits, value.cast(kind)).otherwise(bad)


def loses_digits(text: Column, precision: int, scale: int) -> Column:
    """Whether a number's text doesn't fit decimal(precision, scale) in full."""
    plain = F.regexp_replace(F.trim(text), r"^[+-]", "")
    whole = F.regexp_replace(F.substring_index(plain, ".", 1), "^0+", "")
    part = F.when(F.instr(plain, ".") > 0, F.regexp_replace(F.substring_index(plain, ".", -1), "0+$", "")).otherwise("")
    number = plain.rlike(r"^(\d+\.?\d*|\.\d+)$")
    return text.isNotNull() & (~number | (F.length(part) > scale) | (F.length(whole) > precision - scale))


def strict_decimal(column: Column, precision: int, scale: int) -> Column:
    """The decimal of a number's text; excess digits and NaN fail instead of being rounded."""
    text = column.cast("string")
    kind = T.DecimalType(precision, scale)
    bad = F.raise_error(F.concat(F.lit(f"not a decimal({precision},{scale}): "), text)).cast(kind)
    return F.when(loses_digits(text, precision, scale), bad).otherwise(text.cast(kind))


def shape(cell: Column) -> Column:
    """Of a CSV cell: null if empty, bool for true and false as written, int, float or text."""
    integer = cell.rlike(r"^[+-]?\d+$")
    fits = F.regexp_replace(cell, r"^\+", "").try_cast("bigint").isNotNull()
    real = cell.rlike(r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity|nan))$")
    return F.when(cell.isNull() | (cell == ""), None).when(cell.isin("true", "false"), "bool").when(integer & fits, "int").when(real, "float").otherwise("text")


def survey(df: DataFrame) -> DataFrame:
    """One row: the shape of each text column over all rows. Integers and floats join to float, booleans with anything
    else to text, and a column without values is text."""
    out = []
    for c in df.columns:
        s = shape(F.col(c))
        has = {k: F.bool_or(F.coalesce(s == k, F.lit(False))) for k in ("bool", "int", "float", "text")}
        joined = F.when(has["text"] | (has["bool"] & (has["int"] | has["float"])), "text").when(has["bool"], "bool").when(has["float"], "float").when(has["int"], "int").otherwise("text")
        out.append(joined.alias(c))
    return df.agg(*out)


def is_widening(a: T.DataType, b: T.DataType) -> bool:
    """Whether a column may change from a to b across runs."""
    if a == b:
        return False
    if isinstance(b, T.StringType):
        return not isinstance(a, T.BinaryType)
    if isinstance(a, T.LongType) and isinstance(b, T.DecimalType):
        return b.precision - b.scale >= 19
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale
    return False


def evolve(live: T.StructType, wanted: T.StructType) -> T.StructType:
    """The live schema grown to take the wanted one: new nullable columns come last, types widen; the rest is refused."""
    fields = {f.name: f for f in live.fields}
    for f in wanted.fields:
        old = fields.get(f.name)
        if old is None:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
        elif is_widening(old.dataType, f.dataType):
            fields[f.name] = T.StructField(f.name, f.dataType, old.nullable)
        elif old.dataType != f.dataType and not is_widening(f.dataType, old.dataType):
            raise ValueError(f"column {f.name} is {old.dataType.simpleString()}; {f.dataType.simpleString()} contradicts it")
        elif not old.nullable and f.nullable:
            continue
        elif old.nullable and not f.nullable:
            raise ValueError(f"column {f.name} holds nulls; it can't become required")
    return T.StructType(list(fields.values()))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df by name in the order and types of schema: nullable columns that lack are null, required ones are refused."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        elif f.nullable:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"required column {f.name} is missing")
    return df.select(*out)


def check_session(table: str, before: list[str] | None, now: list[str]) -> None:
    """Within a load a table's columns stay, in their order; new ones come last. Anything else is two streams on one table."""
    if before is None:
        return
    if lost := [c for c in before if c not in now]:
        raise ValueError(f"{table}: {', '.join(lost)} were delivered before in this load and are missing now")
    for k, (was, c) in enumerate(zip(before, now, strict=False)):
        if was != c:
            raise ValueError(f"{table}: column {k} was {was} before in this load and is {c} now")


def check_case(table: str, names: list[str]) -> None:
    """Names that differ by case alone are refused: a reader without case can't tell them apart."""
    lower = [n.lower() for n in names]
    if twice := sorted({n for n in names if lower.count(n.lower()) > 1}):
        raise ValueError(f"{table}: {', '.join(twice)} differ by case alone")
