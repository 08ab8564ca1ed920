"""Column expressions: pseudonyms, rounding, floors, checksums. All of them run in the JVM."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PSEUDONYM_CHARS = 24
REDACTED = "[REDACTED]"
DEFAULT_SALT = "cloakframe-local-salt"


def local_secret(salt: str = "") -> bytes:
    """The key of local pseudonyms: SHA-256 of the salt, or of a fixed one."""
    return hashlib.sha256((salt or DEFAULT_SALT).encode()).digest()


def hmac_pads(secret: bytes) -> tuple[str, str]:
    """Hex of HMAC's inner and outer pads for ``secret``."""
    key = hashlib.sha256(secret).digest() if len(secret) > 64 else secret
    block = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()


def hmac_sha256(value: Column, secret: bytes) -> Column:
    """Hex HMAC-SHA-256 of a string's UTF-8 bytes."""
    inner, outer = hmac_pads(secret)
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def is_missing(col: Column, kind: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    return col.isNull() | F.isnan(col) if isinstance(kind, (T.DoubleType, T.FloatType)) else col.isNull()


def pseudonym(col: Column, kind: T.DataType, secret: bytes) -> Column:
    """The first PSEUDONYM_CHARS of the keyed digest; null and NaN give null."""
    text = F.initcap(col.cast("string")) if isinstance(kind, T.BooleanType) else col.cast("string")
    return F.when(~is_missing(col, kind), F.substring(hmac_sha256(text, secret), 1, PSEUDONYM_CHARS))


def redact(col: Column) -> Column:
    return F.when(col.isNotNull(), F.lit(REDACTED))


def strip(col: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def token_key(col: Column) -> Column:
    return F.lower(strip(col.cast("string")))


def round_number(col: Column, kind: T.DataType, precision: int) -> Column:
    """Half-even rounding; integers stay integers."""
    return F.bround(col, precision).cast(kind) if not isinstance(kind, T.DecimalType) else F.bround(col.cast("double"), precision)


def round_text(col: Column, precision: int) -> Column:
    """A number in a string as a rounded double; null where it is none."""
    return F.bround(col.try_cast("double"), precision)


_DECIMAL = r"-?\d+\.\d+"


def round_wkt(col: Column, precision: int) -> Column:
    """Every decimal number of the string, rounded (to 6.0 and the like at precision 0). What
    a negative number rounds to keeps its sign: -0.0."""
    gaps, found = F.split(col, _DECIMAL, -1), F.regexp_extract_all(col, F.lit(_DECIMAL), F.lit(0))

    def rounded(x: Column) -> Column:
        near = F.bround(x.cast("double"), precision)
        return F.when(x.startswith("-") & (near == 0), F.lit("-0.0")).otherwise(near.cast("string"))

    said = F.transform(found, rounded)
    return F.array_join(F.transform(F.arrays_zip(gaps.alias("g"), said.alias("n")), lambda z: F.concat(z["g"], F.coalesce(z["n"], F.lit("")))), "")


def floor_day(col: Column, kind: T.DataType) -> Column:
    """Midnight of a timestamp, in its own type; other types as they are."""
    return F.date_trunc("DAY", col).cast(kind) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else col


def digits(col: Column) -> Column:
    return F.regexp_replace(col, r"\D", "")


def luhn(col: Column) -> Column:
    """13 digits or more whose Luhn sum is right."""
    d = digits(col)
    return (F.length(d) >= 13) & F.call_function("luhn_check", d)


def iban_ok(col: Column) -> Column:
    """ISO 13616: the first four characters last, letters as numbers, remainder 1 by 97."""
    turned = F.upper(F.concat(F.substring(col, 5, 34), F.substring(col, 1, 4)))
    step = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).when(c.rlike("[A-Z]"), (acc * 100 + F.ascii(c) - 55) % 97).otherwise(acc),
    )
    return (F.length(col) >= 15) & (step == 1)


def ipv4_ok(col: Column) -> Column:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return col.rlike(rf"^{octet}(\.{octet}){{3}}$")


def phone_ok(col: Column) -> Column:
    return (F.length(digits(col)) >= 7) & ~col.rlike("[A-Za-z]")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; null if either is all zeros."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
