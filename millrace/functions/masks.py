"""Masks as column expressions. Every function takes and returns a Column; none leaves the JVM.

``text(c)`` is the value as text. Booleans print as True and False.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALPHANUMERIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
STARS = "*"
# Text dates are tried in these forms, in order.
DATE_FORMS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "yyyyMMdd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d MMM yy",
    "dd.MM.yyyy",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
)


def text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    return value.cast("string")


def stars(count: Column) -> Column:
    return F.repeat(F.lit(STARS), count.cast("int"))


def blank(value: Column, kind: T.DataType) -> Column:
    """Null, empty text, zero and False: values that some masks leave as they are."""
    if isinstance(kind, T.StringType):
        return value.isNull() | (value == "")
    if isinstance(kind, T.BooleanType):
        return value.isNull() | ~value
    if isinstance(kind, T.NumericType):
        return value.isNull() | (value == 0)
    return value.isNull()


def sha256(value: Column, kind: T.DataType) -> Column:
    return F.sha2(text(value, kind), 256)


def md5(value: Column, kind: T.DataType) -> Column:
    return F.md5(text(value, kind))


def hmac_sha256(value: Column, kind: T.DataType, key: str) -> Column:
    """HMAC from nested SHA-256 with the two padded keys as literals."""
    import hashlib

    raw = key.encode()
    raw = hashlib.sha256(raw).digest() if len(raw) > 64 else raw
    raw = raw.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in raw), bytes(b ^ 0x5C for b in raw)
    message = text(value, kind).cast("binary")
    first = F.unhex(F.sha2(F.concat(F.lit(inner), message), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def partial(value: Column, kind: T.DataType, shown: int = 2) -> Column:
    t = text(value, kind)
    size = F.length(t)
    if shown == 0:
        # Nothing is shown in front, and the whole value behind the stars would be a leak.
        masked = stars(size)
    else:
        masked = F.concat(F.substring(t, 1, shown), stars(size - 2 * shown), F.right(t, F.lit(shown)))
    return F.when(blank(value, kind), t).when(size <= 2 * shown, stars(size)).otherwise(masked)


def first_letter(value: Column, kind: T.DataType) -> Column:
    t = text(value, kind)
    size = F.length(t)
    return F.when(blank(value, kind) | (size <= 1), t).otherwise(F.concat(F.substring(t, 1, 1), stars(size - 1)))


def email(value: Column, kind: T.DataType) -> Column:
    t = text(value, kind)
    at = F.instr(t, "@")
    local = F.substring(t, F.lit(1), at - 1)
    size = at - 1
    hidden = F.when(size <= 2, stars(size)).otherwise(
        F.concat(F.substring(t, 1, 1), stars(size - 2), F.right(local, F.lit(1)))
    )
    domain = F.substring(t, at, F.length(t))
    return F.when(blank(value, kind), t).when(at == 0, partial(value, kind, 2)).otherwise(F.concat(hidden, domain))


def digits(value: Column, kind: T.DataType) -> Column:
    return F.regexp_replace(text(value, kind), r"[^0-9]", "")


def phone(value: Column, kind: T.DataType) -> Column:
    d = digits(value, kind)
    return (
        F.when(blank(value, kind), text(value, kind))
        .when(F.length(d) < 10, stars(F.length(d)))
        .otherwise(F.concat(F.substring(d, 1, 3), F.lit("-***-****")))
    )


def credit_card(value: Column, kind: T.DataType) -> Column:
    d = digits(value, kind)
    return (
        F.when(blank(value, kind), text(value, kind))
        .when(F.length(d) < 12, stars(F.length(d)))
        .otherwise(F.concat(stars(F.length(d) - 4), F.right(d, F.lit(4))))
    )


def ssn(value: Column, kind: T.DataType) -> Column:
    d = digits(value, kind)
    return (
        F.when(blank(value, kind), text(value, kind))
        .when(F.length(d) != 9, stars(F.length(d)))
        .otherwise(F.concat(F.lit("***-**-"), F.right(d, F.lit(4))))
    )


def all_stars(value: Column, kind: T.DataType) -> Column:
    return F.when(blank(value, kind), F.lit("")).otherwise(stars(F.length(text(value, kind))))


def rounded(value: Column, kind: T.DataType, precision: int = 10) -> Column:
    """Half-even to a multiple of ``precision``. Text that is no number becomes null."""
    number = value.try_cast("double")
    result = (F.bround(number / F.lit(precision)) * F.lit(precision)).cast("long")
    return result if isinstance(kind, T.NumericType) else result.cast("string")


def bucketed(value: Column, kind: T.DataType, size: int = 100) -> Column:
    number = value.try_cast("double")
    low = (F.floor(number / F.lit(size)) * F.lit(size)).cast("long")
    return F.concat(low.cast("string"), F.lit("-"), (low + F.lit(size)).cast("string"))


def as_date(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(value)
    tries = [F.to_date(F.try_to_timestamp(text(value, kind), F.lit(form))) for form in DATE_FORMS]
    return F.coalesce(*tries)


def is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def year_only(value: Column, kind: T.DataType) -> Column:
    """The year as a number, or as text where the column is text; text that is no date becomes null."""
    year = F.year(as_date(value, kind))
    return year if is_time(kind) else year.cast("string")


def month_year(value: Column, kind: T.DataType) -> Column:
    day = as_date(value, kind)
    label = F.concat_ws("-", F.lpad(F.year(day).cast("string"), 4, "0"), F.lpad(F.month(day).cast("string"), 2, "0"))
    return F.when(day.isNotNull(), label)


def uuid_token(value: Column, kind: T.DataType, salt: str) -> Column:
    """One UUID per distinct value: the value's salted hash in UUID layout, so no shuffle.

    The salt is drawn per run and not kept, so tokens cannot be linked across runs.
    """
    h = F.sha2(F.concat(F.lit(salt + ":"), text(value, kind)), 256)
    variant = F.element_at(
        F.array(*[F.lit(x) for x in "89ab"]), (F.pmod(F.xxhash64(h), F.lit(4)) + 1).cast("int")
    )
    return F.when(
        value.isNotNull(),
        F.concat(
            F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"), F.substring(h, 14, 3),
            F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
        ),
    )


def whole(number: Column) -> Column:
    """A double as bigint, the ends of the type for what lies beyond."""
    low, high = F.lit(-(2**63)).cast("bigint"), F.lit(2**63 - 1).cast("bigint")
    return F.coalesce(number.try_cast("bigint"), F.when(number > 0, high).when(number < 0, low))


def noise(value: Column, kind: T.DataType, level: float = 0.1) -> Column:
    number = value.try_cast("double")
    moved = number + (F.rand() * 2 - 1) * F.lit(level) * F.abs(number)
    if isinstance(kind, T.IntegralType):
        # A number near the end of its type may move past it.
        return whole(moved - moved % 1)
    if isinstance(kind, T.NumericType):
        return moved.cast(kind)
    return moved.cast("string")


def date_shift(value: Column, kind: T.DataType, days: int = 30) -> Column:
    """Each cell moves by its own number of days, up to ``days`` either way."""
    shift = (F.floor(F.rand() * F.lit(2 * days + 1)) - F.lit(days)).cast("int")
    if isinstance(kind, T.DateType):
        return F.date_add(value, shift)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value + F.make_dt_interval(days=shift)
    return F.date_format(F.date_add(as_date(value, kind), shift), "yyyy-MM-dd")


def random_value(value: Column, kind: T.DataType) -> Column:
    """Same number of digits, same magnitude or same length, otherwise unrelated to the value."""
    if isinstance(kind, T.BooleanType):
        # A flag counts as a one-digit number.
        return F.when(value.isNotNull(), F.floor(F.rand() * 9 + 1).cast("long"))
    if isinstance(kind, T.IntegralType):
        size = F.length(F.abs(value.cast("decimal(20,0)")).cast("string"))
        low = F.pow(F.lit(10.0), (size - 1).cast("double"))
        return F.when(value.isNotNull(), whole(F.round(low + F.rand() * (low * 9 - 1))))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value.isNotNull(), (F.rand() * F.abs(value) * 2).cast(kind))
    if isinstance(kind, T.StringType):
        seed = F.uuid()
        return F.when(value.isNull(), None).when(value == "", "").otherwise(random_text(F.length(value), seed))
    if isinstance(kind, T.DecimalType):
        return F.when(value.isNotNull(), (F.rand().cast(T.DecimalType(18, 17)) * F.abs(value)).try_cast(kind))
    # Any day or time of a century, whatever the value was.
    day = F.date_add(F.lit("1950-01-01").cast("date"), F.floor(F.rand() * 36525).cast("int"))
    if isinstance(kind, T.DateType):
        return F.when(value.isNotNull(), day)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.when(value.isNotNull(), (day.cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(F.rand() * 86400))).cast(kind))
    # Nothing random of such a type is known; null gives nothing away.
    return F.lit(None).cast("string")


def random_text(size: Column, seed: Column) -> Column:
    """``size`` random letters and digits from one random seed."""
    holder = F.array(seed)
    return F.element_at(
        F.transform(
            holder,
            lambda s: F.array_join(
                F.transform(
                    F.sequence(F.lit(1), size),
                    lambda i: F.substring(
                        F.lit(ALPHANUMERIC), (F.pmod(F.xxhash64(s, i), F.lit(len(ALPHANUMERIC))) + 1).cast("int"), F.lit(1)
                    ),
                ),
                "",
            ),
        ),
        1,
    )
