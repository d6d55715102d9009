"""Column expressions that turn the text values of a change log into typed values.

Every function maps a text column to a column; a value that cannot be converted becomes null
and never raises, so that the failure policy can be applied to whole columns later.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from changeflow.model import EMPTY_BLOB, EMPTY_CLOB

# wide enough for every 64-bit integer and 18 fraction digits
WIDE = "decimal(38,18)"


# ---------------------------------------------------------------- numbers


def integer_width(length: int, scale: int) -> str | None:
    """Spark type of a number without fraction digits; null when it needs a decimal."""
    width = length - scale
    for limit, name in ((3, "tinyint"), (5, "smallint"), (10, "int"), (19, "bigint")):
        if width < limit:
            return name
    return None


def to_integer(text: Column, spark_type: str) -> Column:
    """Fraction digits are cut off; a tinyint keeps the low byte, wider types must fit."""
    whole = text.try_cast(WIDE).try_cast("bigint")
    if spark_type == "tinyint":
        return wrap_byte(whole)
    return whole.try_cast(spark_type)


def wrap_byte(number: Column) -> Column:
    """Low byte as a signed number."""
    return (F.pmod(number + 128, F.lit(256)) - 128).cast("tinyint")


def to_tinyint(text: Column) -> Column:
    """Text that is a byte, or true / false."""
    lower = F.lower(text)
    flag = F.when(lower == "true", 1).when(lower == "false", 0)
    plain = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("tinyint"))
    return F.coalesce(flag.cast("tinyint"), plain)


def to_boolean(text: Column) -> Column:
    """0 is false, any other byte is true; decimals count by their low byte."""
    number = F.when(text.rlike(r"^[+-]?\d+(\.\d*)?$"), text.try_cast(WIDE).try_cast("bigint"))
    return wrap_byte(number) != 0


def to_decimal(text: Column, length: int, scale: int) -> Column:
    """Value padded to the column's scale. A value with more digits than the scale allows is an error.

    A negative scale stands for rounding to tens, hundreds and so on, which must have happened already.
    """
    if scale >= 0:
        size = min(38, max(length, scale, 1))
        value = text.try_cast(f"decimal({size},{min(scale, size)})")
        extra = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1)) > scale
        return F.when(~F.coalesce(extra, F.lit(False)), value)
    unit = F.lit(10 ** -scale).cast("decimal(38,0)")
    value = F.when(~F.coalesce(text.rlike(r"\.\d*[1-9]"), F.lit(False)), text.try_cast(f"decimal({min(38, length - scale)},0)"))
    return F.when(value % unit == 0, value)


def to_variable_scale(text: Column) -> Column:
    """``struct<scale, value>`` of a number whose column has no scale."""
    shape = r"^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?$"
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, shape, 4), F.lit("")).try_cast("int"), F.lit(0))
    scale = F.length(F.regexp_extract(text, shape, 3)) - exponent
    known = text.rlike(shape) & text.rlike(r"\d")
    plain = F.when(text.rlike("[eE]"), text.try_cast("decimal(38,0)").cast("string")).otherwise(text)
    return F.when(known, F.struct(scale.cast("int").alias("scale"), plain.alias("value")))


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


# ---------------------------------------------------------------- text and bytes


def to_string(text: Column, optional: bool, is_lob: bool = False, lob_enabled: bool = True) -> Column:
    """Empty text and the empty-CLOB call are null, or '' in a required column.

    With large objects off, a large object counts as empty.
    """
    empty = F.lit(None).cast("string") if optional else F.lit("")
    if is_lob and not lob_enabled:
        return F.when(text.isNotNull(), empty)
    return F.when((text == "") | (text == EMPTY_CLOB), empty).otherwise(text)


def to_binary(hex_text: Column, optional: bool, mode: str = "bytes", is_lob: bool = False, lob_enabled: bool = True) -> Column:
    """Hex text as bytes, or as text in mode base64, base64-url-safe or hex."""
    if is_lob and not lob_enabled:
        raw = F.lit(None).cast("binary") if optional else F.when(hex_text.isNotNull(), F.lit(bytes([0])))
    else:
        empty = F.lit(None).cast("binary") if optional else F.lit(b"")
        raw = F.when(hex_text == EMPTY_BLOB, empty).otherwise(F.try_to_binary(hex_text, F.lit("hex")))
    return encode_binary(raw, mode)


def encode_binary(raw: Column, mode: str) -> Column:
    if mode == "bytes":
        return raw
    if mode == "base64":
        return F.base64(raw)
    if mode == "base64-url-safe":
        return F.translate(F.base64(raw), "+/", "-_")
    if mode == "hex":
        return F.lower(F.hex(raw))
    raise ValueError(f"unknown binary mode {mode}")


def to_json_text(text: Column) -> Column:
    """Passes as it is; null stays null."""
    return text


def to_bits(text: Column, length: int) -> Column:
    """``'0101'`` as a boolean (length 1) or as bytes, first bit highest."""
    digits = F.regexp_replace(text, r"^[bB]?'?|'$", "")
    if length <= 1:
        number = digits.try_cast("smallint")
        return F.when(number.isNotNull(), number != 0).otherwise(F.lower(digits) == "true")
    size = F.ceil(F.length(digits) / 8).cast("int")
    # one output byte per eight bits, so the length of the text is no limit
    padded = F.lpad(digits, size * 8, F.lit("0"))
    byte = lambda i: F.lpad(F.conv(F.substr(padded, i * 8 + 1, F.lit(8)), 2, 16), 2, "0")
    hexed = F.array_join(F.transform(F.sequence(F.lit(0), size - 1), byte), "")
    return F.when(digits.rlike("^[01]+$"), F.unhex(hexed))


# ---------------------------------------------------------------- time

# Fixed value: the average month of 365.25 / 12 days, in microseconds.
MONTH_MICROS = 2_629_800_000_000
SECOND = 1_000_000


def _micros(fraction: Column) -> Column:
    return F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("bigint")


_LITERAL = r"(?is)^\s*TO_(?:TIMESTAMP\('([^']*)'|DATE\('([^']*)',[ ]*'[^']*')\)\s*$"
_ISO = r"^\s*\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{0,9})?\s*$"
_AM_PM = r"(?i)^\s*(\d{2}-[A-Z]{3}-\d{2} \d{2}\.\d{2}\.\d{2})(?:\.(\d{0,9}))? ([AP]M)\s*$"


def _am_pm_micros(text: Column) -> Column:
    day = F.initcap(F.regexp_extract(text, _AM_PM, 1))
    base = F.try_to_timestamp(
        F.concat_ws(" ", day, F.upper(F.regexp_extract(text, _AM_PM, 3))), F.lit("dd-MMM-yy hh.mm.ss a")
    )
    return F.unix_micros(base) + _micros(F.regexp_extract(text, _AM_PM, 2))


def literal_text(text: Column) -> Column:
    """The text inside ``TO_TIMESTAMP('...')`` or ``TO_DATE('...', '...')``; other text as it is."""
    return F.when(text.startswith("T") | text.startswith("t") | text.startswith(" "), F.regexp_replace(text, _LITERAL, "$1$2")).otherwise(text)


def inner_micros(inner: Column) -> Column:
    """Epoch microseconds (UTC) of a bare timestamp text; whole numbers pass as microseconds.

    The common form costs one pattern test and one cast per value.
    """
    return (
        F.when(inner.rlike(_ISO), F.unix_micros(inner.try_cast("timestamp")))
        .when(inner.rlike(r"^-?\d+$"), inner.try_cast("bigint"))
        .when(inner.rlike(_AM_PM), _am_pm_micros(inner))
    )


def literal_micros(text: Column) -> Column:
    return inner_micros(literal_text(text))


def to_timestamp(inner: Column, mode: str = "timestamp") -> Column:
    """Bare timestamp text by precision mode: timestamp, connect (millisecond timestamp), millis, micros, nanos."""
    micros = inner_micros(inner)
    if mode == "nanos":
        rest = F.rpad(F.regexp_extract(inner, r"\.\d{6}(\d{1,3})", 1), 3, "0").cast("bigint")
        return micros * 1000 + rest
    to_milli = micros - F.pmod(micros, F.lit(1000))
    if mode == "timestamp":
        return F.timestamp_micros(micros)
    if mode == "micros":
        return micros
    if mode == "millis":
        return F.unix_millis(F.timestamp_micros(micros))
    if mode == "connect":
        return F.timestamp_micros(to_milli)
    raise ValueError(f"unknown temporal mode {mode}")


_TZ = r"(?is)^\s*TO_TIMESTAMP_TZ\('\s*(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2})(?:\.(\d{0,9}))? ?([+-]\d{2}:\d{2})?\s*'\)\s*$"


def to_zoned_text(text: Column, fraction_digits: int = 6) -> Column:
    """``TO_TIMESTAMP_TZ('...')`` as ISO text in its own offset, with the column's fraction digits."""
    part = lambda i: F.regexp_extract(text, _TZ, i)
    fraction = F.lit("") if fraction_digits <= 0 else F.concat(
        F.lit("."), F.rpad(F.substring(part(3), 1, fraction_digits), fraction_digits, "0")
    )
    offset = F.when(part(4).isin("", "+00:00", "-00:00"), "Z").otherwise(part(4))
    valid = F.try_to_timestamp(F.concat_ws(" ", part(1), part(2)), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    return F.when(text.rlike(_TZ) & valid, F.concat(part(1), F.lit("T"), part(2), fraction, offset))


def zoned_instant(iso: Column) -> Column:
    return iso.try_cast("timestamp")


def iso_seconds(micros: Column) -> Column:
    """Microseconds as seconds text without trailing zeros."""
    text = (micros / F.lit(SECOND).cast("decimal(10,0)")).cast("decimal(38,6)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def _iso_interval(y: Column, mo: Column, d: Column, h: Column, mi: Column, micros: Column) -> Column:
    # fixed shape P<y>Y<mo>M<d>DT<h>H<mi>M<s>S; every part carries its own sign
    s = F.when(micros == 0, "0").otherwise(iso_seconds(micros.cast("decimal(38,0)")))
    return F.concat(
        F.lit("P"), y.cast("string"), F.lit("Y"), mo.cast("string"), F.lit("M"), d.cast("string"), F.lit("DT"),
        h.cast("string"), F.lit("H"), mi.cast("string"), F.lit("M"), s, F.lit("S"),
    )


def _interval_number(text: Column, mode: str) -> Column:
    number = F.when(text.rlike(r"^[+-]?\d+(\.\d+)?$"), text.try_cast(WIDE).try_cast("bigint"))
    if mode == "numeric":
        return number
    zero = F.lit(0)
    return F.when(number.isNotNull(), _iso_interval(zero, zero, zero, zero, zero, number))


def to_year_month(text: Column, mode: str = "numeric") -> Column:
    """``[-]y-m``, or microseconds, as microseconds (average month) or ISO text."""
    shape = r"^\s*(-)?(\d+)-(\d+)\s*$"
    sign = F.when(F.regexp_extract(text, shape, 1) == "-", -1).otherwise(1)
    part = lambda i: sign * F.regexp_extract(text, shape, i).try_cast("bigint")
    if mode == "numeric":
        found = (part(2) * 12 + part(3)) * MONTH_MICROS
    else:
        zero = F.lit(0)
        found = _iso_interval(part(2), part(3), zero, zero, zero, zero)
    return F.when(text.rlike(shape), found).otherwise(_interval_number(text, mode))


def to_day_second(text: Column, mode: str = "numeric") -> Column:
    """``[+-]d h:m:s.f``, or microseconds, as microseconds or ISO text."""
    shape = r"^\s*([+-])?(\d+) (\d+):(\d+):(\d+)\.(\d+)\s*$"
    sign = F.when(F.regexp_extract(text, shape, 1) == "-", -1).otherwise(1)
    part = lambda i: sign * F.regexp_extract(text, shape, i).try_cast("bigint")
    seconds = part(5) * SECOND + sign * F.rpad(F.substring(F.regexp_extract(text, shape, 6), 1, 6), 6, "0").try_cast("bigint")
    if mode == "numeric":
        found = ((part(2) * 24 + part(3)) * 60 + part(4)) * 60 * SECOND + seconds
    else:
        zero = F.lit(0)
        found = _iso_interval(zero, zero, part(2), part(3), part(4), seconds)
    return F.when(text.rlike(shape), found).otherwise(_interval_number(text, mode))


def to_duration(text: Column) -> Column:
    """``[-]h:m[:s[.f]]``, quoted or not, or the time of a ``y-m-d h:m:s[.f]`` timestamp, as signed microseconds.

    Hours have any number of digits, minutes and seconds one or two, fractions up to nine; other texts are null.
    """
    bare = F.trim(F.trim(text), F.lit("'"))
    words = F.split(bare, " ")
    day = F.split(F.get(words, 0), "-")
    stamped = (F.size(words) == 2) & (F.size(day) == 3) & F.forall(day, lambda x: _whole(x, 4)) & ~F.startswith(F.get(words, 1), F.lit("-"))
    clock = F.when(stamped, F.get(words, 1)).when(F.size(words) == 1, bare)
    negative = F.startswith(clock, F.lit("-"))
    parts = F.split(F.when(negative, F.substring(clock, F.lit(2), F.length(clock))).otherwise(clock), ":")
    last = F.split(F.get(parts, 2), r"\.")
    seconds, fraction = F.coalesce(F.get(last, 0), F.lit("0")), F.coalesce(F.get(last, 1), F.lit("0"))
    fits = (
        F.when(stamped, F.size(parts) == 3).otherwise(F.size(parts).between(2, 3)) & _whole(F.get(parts, 0), 18) & _whole(F.get(parts, 1), 2)
        & _whole(seconds, 2) & _whole(fraction, 9) & F.coalesce(F.size(last) <= 2, F.lit(True))
    )
    number = lambda x: x.try_cast("bigint")
    total = (number(F.get(parts, 0)) * 3600 + number(F.get(parts, 1)) * 60 + number(seconds)) * SECOND + number(F.rpad(F.substring(fraction, 1, 6), 6, "0"))
    return F.when(fits, F.when(negative, -total).otherwise(total))


def _whole(text: Column, digits: int) -> Column:
    """One to ``digits`` digits and nothing else."""
    return F.length(text).between(1, digits) & (F.translate(text, "0123456789", "") == "")


# ---------------------------------------------------------------- text formats of temporal columns


def date_text(value: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(value, fmt)


def time_text(micros_of_day: Column, fmt: str = "HH:mm:ss.SSSSSS") -> Column:
    return F.date_format(F.timestamp_micros(micros_of_day), fmt)


def timestamp_text(value: Column, fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", cut_to_millis: bool = False) -> Column:
    return F.date_format(F.date_trunc("millisecond", value) if cut_to_millis else value, fmt)


# ---------------------------------------------------------------- defaults

_NOW = ("SYSDATE", "CURRENT_TIMESTAMP")


def unquote_literal(text: Column) -> Column:
    bracketed = r"(?s)^\('(.*)'\)$"
    quoted = r"(?s)^'(.*)'$"
    return (
        F.when(text.rlike(bracketed), F.regexp_extract(text, bracketed, 1))
        .when(text.rlike(quoted), F.regexp_extract(text, quoted, 1))
        .otherwise(text)
    )


def default_value(default: Column, jdbc: Column, length: Column, scale: Column, optional: Column) -> Column:
    """A column default as canonical text by JDBC type; null where it has none or is not a constant.

    Numbers are padded to the column's scale, times are epoch microseconds, intervals microseconds.
    """
    text = F.trim(default)
    bare = unquote_literal(text)
    now = F.upper(bare).isin(*_NOW)
    places = F.greatest(F.coalesce(scale, F.lit(0)), F.lit(0))
    fraction = F.regexp_extract(text, r"\.(\d*?)0*$", 1)
    whole_part = F.regexp_extract(text, r"^\+?(-?\d+)", 1)
    scaled = F.when(places > 0, F.concat(whole_part, F.lit("."), F.rpad(fraction, places, F.lit("0")))).otherwise(whole_part)
    as_written = F.regexp_replace(text, r"^\+", "")
    number = F.when(
        text.rlike(r"^[+-]?\d+(\.\d*)?$"),
        F.when(scale.isNull(), as_written).when(F.length(fraction) <= places, scaled),
    )
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint").cast("string"))
    real = text.try_cast("double").cast("string")
    flag = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int") != 0).otherwise(F.lower(text) == "true")
    stamp = F.when(now & optional, None).when(now, F.lit(0).cast("bigint")).when(
        bare.rlike(r"^\d{4}-\d{2}-\d{2}$"), literal_micros(F.concat(bare, F.lit(" 00:00:00")))
    ).otherwise(F.when(~bare.rlike(r"^-?\d+$"), literal_micros(bare)))
    zoned = F.when(now & ~optional, F.lit("1970-01-01T00:00:00Z")).when(~now, to_zoned_text(bare))
    time = F.when(now & ~optional, F.lit(0).cast("bigint")).when(~now, to_duration(bare))
    varchar = F.when(bare == "", F.when(~optional, F.lit(""))).otherwise(bare)
    padded = F.when(F.length(bare) < length, F.rpad(bare, length, F.lit(" "))).otherwise(bare)
    return F.when(
        text.isNotNull() & (F.upper(text) != "NULL"),
        F.when(jdbc.isin("NUMERIC", "DECIMAL"), number)
        .when(jdbc.isin("INTEGER", "BIGINT", "SMALLINT", "TINYINT"), whole)
        .when(jdbc.isin("FLOAT", "DOUBLE", "REAL"), real)
        .when(jdbc == "BOOLEAN", flag.cast("string"))
        .when(jdbc.isin("TIMESTAMP", "DATE"), stamp.cast("string"))
        .when(jdbc == "TIMESTAMP_TZ", zoned)
        .when(jdbc == "TIME", time.cast("string"))
        .when(jdbc == "YM_INTERVAL", to_year_month(bare).cast("string"))
        .when(jdbc == "DS_INTERVAL", to_day_second(bare).cast("string"))
        .when(jdbc.isin("CHAR", "NCHAR"), padded)
        .when(jdbc.isin("VARCHAR", "NVARCHAR"), varchar),
    )
