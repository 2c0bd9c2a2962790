"""Dictionary type codes to Spark types, type text and audit findings."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conninfo import BridgeError
from .charset import decoded
from .text import char_text, decfloat_text

#: Dictionary codes of the source's types.
SMALLINT, INTEGER, FLOAT, DATE, TIME, CHAR, BIGINT, BOOLEAN, DECFLOAT16, DECFLOAT34, INT128, DOUBLE, D_FLOAT, TIME_TZ, TIMESTAMP_TZ, TIME_TZ_EX, TIMESTAMP_TZ_EX, TIMESTAMP, VARCHAR, BLOB = 7, 8, 10, 12, 13, 14, 16, 23, 24, 25, 26, 27, 11, 28, 29, 30, 31, 35, 37, 261

TYPE_NAMES = {SMALLINT: "SMALLINT", INTEGER: "INTEGER", FLOAT: "FLOAT", DATE: "DATE", TIME: "TIME", CHAR: "CHAR", BIGINT: "BIGINT", BOOLEAN: "BOOLEAN", DECFLOAT16: "DECFLOAT(16)", DECFLOAT34: "DECFLOAT(34)", INT128: "INT128", DOUBLE: "DOUBLE PRECISION", D_FLOAT: "D_FLOAT", TIME_TZ: "TIME WITH TIME ZONE", TIMESTAMP_TZ: "TIMESTAMP WITH TIME ZONE", TIME_TZ_EX: "TIME WITH TIME ZONE", TIMESTAMP_TZ_EX: "TIMESTAMP WITH TIME ZONE", TIMESTAMP: "TIMESTAMP", VARCHAR: "VARCHAR", BLOB: "BLOB"}

#: Digits that a scaled integer can hold, by its storage.
WIDTH = {SMALLINT: 4, INTEGER: 9, BIGINT: 18, INT128: 38}


def spark_type(code: int, subtype: int = 0, scale: int = 0, charset_id: int = -1, none_encoding: str = "win1252", int128: str = "string") -> T.DataType:
    """The type a column surfaces as; raises for an unknown code."""
    if code in WIDTH and scale:
        digits = -scale
        return T.DecimalType(WIDTH[code], digits) if 0 < digits <= WIDTH[code] else T.DoubleType()
    if code == INT128:
        return T.StringType() if int128 == "string" else T.DecimalType(38, 0)
    if code in (CHAR, VARCHAR) or code == BLOB and subtype == 1:
        return T.BinaryType() if charset_id == 0 and none_encoding == "blob" else T.StringType()
    fixed = {SMALLINT: T.ShortType(), INTEGER: T.IntegerType(), BIGINT: T.LongType(), FLOAT: T.FloatType(), DOUBLE: T.DoubleType(), D_FLOAT: T.DoubleType(), DECFLOAT16: T.StringType(), DECFLOAT34: T.StringType(), DATE: T.DateType(), TIME: T.StringType(), TIMESTAMP: T.TimestampNTZType(), TIMESTAMP_TZ: T.TimestampType(), TIMESTAMP_TZ_EX: T.TimestampType(), TIME_TZ: T.StringType(), TIME_TZ_EX: T.StringType(), BOOLEAN: T.BooleanType(), BLOB: T.BinaryType()}
    if code not in fixed:
        raise BridgeError(f"type code {code} is not supported")
    return fixed[code]


def surfaced(field: T.StructField, relation, opts) -> Column | None:
    """A stored column as its declared type, or null where it is that already.

    Integers with a scale are stored without their decimal point; text without a charset is
    decoded; fixed width loses its trailing spaces; 128-bit integers and decimal floats are
    exact text, unless ``int128`` asks for a decimal.
    """
    name, kind = field.name, field.dataType
    column = F.col(f"`{name}`")
    if name in relation.none_charset and isinstance(kind, T.BinaryType):
        return None if opts.none_encoding == "blob" else decoded(column, opts.none_encoding, name)
    if name not in relation.codes:
        return None
    code, subtype, scale = relation.codes[name]
    target = spark_type(code, subtype, scale, 0 if name in relation.none_charset else -1, opts.none_encoding, opts.int128)
    if code == CHAR:
        return char_text(column.cast("string"))
    if code in (DECFLOAT16, DECFLOAT34):
        return decfloat_text(column)
    if isinstance(target, T.DecimalType) and scale < 0 and isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
        return (column.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(scale))).cast(target)
    return None if kind == target else column.cast(target)


def code_of(kind: T.DataType) -> int:
    """The dictionary code that describes a Spark column."""
    if isinstance(kind, T.DecimalType):
        return BIGINT if kind.precision <= 18 else INT128
    return {T.ByteType: SMALLINT, T.ShortType: SMALLINT, T.IntegerType: INTEGER, T.LongType: BIGINT, T.FloatType: FLOAT, T.DoubleType: DOUBLE, T.StringType: VARCHAR, T.BinaryType: BLOB, T.BooleanType: BOOLEAN, T.DateType: DATE, T.TimestampType: TIMESTAMP_TZ, T.TimestampNTZType: TIMESTAMP}.get(type(kind), BLOB)


def type_text(code: Column, subtype: Column, scale: Column) -> Column:
    """The type's name as text; ``TYPE_<n>`` for an unknown code."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    numeric = F.when(subtype == 1, F.lit("NUMERIC")).when((subtype == 2) | (scale < 0), F.lit("DECIMAL"))
    plain = F.coalesce(F.try_element_at(names, code), F.concat(F.lit("TYPE_"), code.cast("string")))
    plain = F.when((code == BLOB) & (subtype == 1), F.lit("BLOB SUB_TYPE TEXT")).when(code == BLOB, F.lit("BLOB")).otherwise(plain)
    return F.when(code.isin(SMALLINT, INTEGER, BIGINT, INT128) & (scale < 0), numeric).otherwise(plain)


def audit_finding(code: Column, subtype: Column, scale: Column, charset_id: Column) -> Column:
    """What a reader should know of a column's type; null where the mapping loses nothing."""
    text = code.isin(CHAR, VARCHAR) | ((code == BLOB) & (subtype == 1))
    return (
        F.when(code.isin(DECFLOAT16, DECFLOAT34), "decfloat_as_varchar")
        .when((code == INT128) & (F.coalesce(scale, F.lit(0)) == 0), "int128")
        .when(code.isin(TIME_TZ, TIME_TZ_EX), "time_tz")
        .when(code.isin(TIMESTAMP_TZ, TIMESTAMP_TZ_EX), "timestamp_tz")
        .when(text & (charset_id == 0), "none_charset")
        .when((code == BLOB) & (subtype == 1), "blob_text")
    )


#: What each finding means.
FINDING_DETAIL = {
    "decfloat_as_varchar": "decimal float is read as exact text; filters compare text",
    "int128": "128-bit integer is read as exact text; cast before numeric comparison",
    "time_tz": "the zone of a time is dropped",
    "timestamp_tz": "the instant is kept in UTC; the zone name is dropped",
    "none_charset": "no declared charset; text is decoded by none_encoding and its filters are not pushed",
    "blob_text": "text BLOB is read whole as a string",
}
