"""Typed values kept as text: storing, parsing, coercing and comparing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .text import is_blank, load_text, repaired, strip

NUMERIC = ("int", "double", "currency", "percent")


def float_text(c: Column) -> Column:
    """Shortest decimal spelling of a double: positional from 1e-4 up to 1e16, otherwise
    with a two-digit signed exponent.  (A plain cast changes notation at 1e7.)"""
    x = c.cast("double")
    fixed = F.regexp_replace(F.format_string("%s", x.cast("decimal(38,21)").cast("string")), r"(\.\d+?)0+$", "$1")
    java = x.cast("string")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1).cast("int")
    science = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"),
                       F.lpad(F.abs(power).cast("string"), 2, "0"))
    size = F.abs(x)
    return (F.when(F.isnan(x), F.lit("nan"))
             .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
             .when(~java.contains("E"), java)
             .when((size >= 1e-4) & (size < 1e16), fixed)
             .otherwise(science))


def stored(c: Column, kind: T.DataType) -> Column:
    """Any column as the text kept in a long extract."""
    if isinstance(kind, T.StringType):
        return repaired(c)
    if isinstance(kind, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float_text(c)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        # A variant sorts object keys, so equal values give equal text.
        return F.to_json(F.parse_json(F.to_json(c)))
    return c.cast("string")


def parsed_bool(c: Column) -> Column:
    return F.when(~is_blank(c), F.lower(strip(c)) == "true")


def parsed_float(c: Column) -> Column:
    return F.when(~is_blank(c), strip(c).try_cast("double"))


def whole_text(number: Column) -> Column:
    """The exact whole part of a double as text; null from 1e38 on, for infinities and NaN."""
    size = F.abs(number)
    small = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("string")

    def big(size: Column) -> Column:
        # Doubles from 2 ** 63 on are whole; they are taken apart into pieces that a double holds exactly.
        high = F.floor(size / 2.0 ** 64).cast("decimal(20,0)")
        rest = size - F.floor(size / 2.0 ** 64).cast("double") * 2.0 ** 64
        middle = F.floor(rest / 2.0 ** 32).cast("decimal(20,0)")
        low = (rest - F.floor(rest / 2.0 ** 32).cast("double") * 2.0 ** 32).cast("decimal(20,0)")
        whole = (high * F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("decimal(38,0)") + middle * F.lit(str(1 << 32)).cast("decimal(10,0)") + low
        return whole.cast("decimal(38,0)").cast("string")
    # Such numbers are rare.  As a function of an array item the steps stay out of the generated code, whose methods
    # the JVM compiles only up to 8,000 bytes.
    digits = F.get(F.transform(F.array(size), big), F.lit(0))
    return F.when(size < 2.0 ** 63, small).when(size < 1e38, F.concat(F.when(number < 0, "-").otherwise(""), digits))


def coerced(c: Column, kind: Column, text: Column | None = None, number: Column | None = None) -> Column:
    """Text shaped by the catalogue type: booleans, whole numbers cut towards zero, doubles.
    A number that does not parse gives null; :func:`is_bad_number` reports it.  Callers that
    already hold the trimmed text and its number as columns pass them in, which keeps the
    generated code small."""
    text = load_text(c) if text is None else text
    number = text.try_cast("double") if number is None else number
    return (F.when(text.isNull(), None)
             .when(kind == "boolean", (F.lower(text) == "true").cast("string"))
             .when(kind == "int", whole_text(number))
             .when(kind.isin("double", "currency", "percent"), float_text(number))
             .otherwise(c))


def is_bad_number(c: Column, kind: Column, text: Column | None = None, number: Column | None = None) -> Column:
    text = load_text(c) if text is None else text
    number = text.try_cast("double") if number is None else number
    endless = (kind == "int") & ~(F.abs(number) < 1e38)
    return F.coalesce(kind.isin(*NUMERIC) & text.isNotNull() & (number.isNull() | endless), F.lit(False))


def equivalent(a: Column, b: Column, kind: Column) -> Column:
    """Type-aware equality; two blanks are equal whatever the type."""
    return (F.when(is_blank(a) & is_blank(b), F.lit(True))
             .when(kind == "boolean", parsed_bool(a).eqNullSafe(parsed_bool(b)))
             .when(kind.isin(*NUMERIC), parsed_float(a).eqNullSafe(parsed_float(b)))
             .otherwise(strip(F.coalesce(a, F.lit("None"))) == strip(F.coalesce(b, F.lit("None")))))


def lookup_key(c: Column, text: Column | None = None) -> Column:
    """Typed lookup key: blank, boolean or trimmed text (``text``, if already at hand)."""
    text = load_text(c) if text is None else text
    low = F.lower(text)
    return (F.when(text.isNull(), F.lit("blank"))
             .when(low.isin("true", "false"), F.concat(F.lit("bool:"), low))
             .otherwise(F.concat(F.lit("text:"), text)))


def outcome(success: Column, kind: T.DataType | None = None, errors: Column | None = None) -> Column:
    """Success flag of a result, by the type of the flag (text, if not given).

    A boolean is itself, text is true if it says ``true``, a number if it is not zero.  A variant is judged by what it
    holds.  Without a flag, and with listed errors beside a number, the row failed.
    """
    failed = F.lit(False) if errors is None else F.coalesce(F.size(errors) > 0, F.lit(False))
    text = lambda c: F.lower(strip(c.cast("string"))) == "true"
    if isinstance(kind, T.VariantType):
        shape = F.schema_of_variant(success)
        value = F.try_variant_get(success, "$", "string")
        number = ~failed & (F.try_variant_get(success, "$", "double") != 0)
        return F.coalesce(F.when(shape.isin("STRING", "BOOLEAN"), text(value)).when(shape.startswith("OBJECT") | shape.startswith("ARRAY"), ~failed & (F.length(value) > 2))
                          .when(shape != "VOID", number), F.lit(False))
    if isinstance(kind, (T.NumericType,)):
        return F.coalesce(~failed & (success != 0), F.lit(False))
    return F.coalesce(text(success), F.lit(False))
