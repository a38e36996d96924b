"""Row-wise rules. Each function takes and returns columns, so it serves batch and stream alike."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.schemas import CROSS_BORDER_REGIONS, PAYMENT_TYPES, TYPE_TO_CHANNEL

# Limits of the risk and amount classes.
AMOUNT_HIGH, AMOUNT_MEDIUM, LARGE_AMOUNT = 1000, 300, 500
RISK_CRITICAL, RISK_HIGH, RISK_MEDIUM = 80, 60, 30
SEVERITY_CRITICAL, SEVERITY_HIGH = 95, 80
MONEY_DIGITS, MONEY_LIMIT = 6, 1e18
PART = 1_000_000
MICROS = 1_000_000
HOUR, DAY = 3600 * MICROS, 86400 * MICROS


def event_time(text: Column) -> Column:
    """ISO text to timestamp; unreadable text gives null instead of failing the job."""
    return F.try_to_timestamp(text)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def is_finite(value: Column) -> Column:
    """Neither missing nor NaN nor infinite; false, not null, for a missing value."""
    value = value.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def money(amount: Column, digits: int = MONEY_DIGITS) -> Column:
    """An amount with `digits` decimals, so that sums are exact in any order.

    NaN, infinite amounts and those of 10**18 and more are no money: they count as missing.
    """
    return F.when(_sound(amount), amount).cast(f"decimal({18 + digits},{digits})")


def _sound(amount: Column) -> Column:
    """NaN is larger than any limit."""
    return F.abs(amount) < MONEY_LIMIT


def money_sum(amount: Column, digits: int = MONEY_DIGITS) -> Column:
    """The exact sum of amounts, as `money` rounds them (halves go up), null if there are none.

    Three sums of long numbers (millions, units, fractions) stay on the fast path of aggregation, which
    decimals of this width leave; the total is put together once per group. It holds 9 * 10**12 rows
    and totals of 9 * 10**24; more raises an error.
    """
    sound = _sound(amount)
    units = F.floor(amount).cast("long")
    millions = F.floor(units / F.lit(float(PART))).cast("long")
    fraction = F.floor((amount - units) * F.lit(10**digits) + F.lit(0.5)).cast("long")

    def added(part: Column, place: Decimal) -> Column:
        return F.sum(F.when(sound, part)).cast("decimal(19,0)") * F.lit(place)

    whole = added(millions, Decimal(PART)) + added(units - millions * PART, Decimal(1))
    return (whole + added(fraction, Decimal(1).scaleb(-digits))).cast("double")


def money_avg(amount: Column, digits: int = MONEY_DIGITS) -> Column:
    return F.try_divide(money_sum(amount, digits), F.count(F.when(_sound(amount), 1)))


def sequence_number(df: DataFrame, name: str) -> Column:
    """A numeric column as it is; of a text id the number its digits make."""
    if dict(df.dtypes)[name] != "string":
        return F.col(name)
    return F.regexp_replace(name, r"\D", "").try_cast("long")


def amount_category(amount: Column) -> Column:
    return (
        F.when(amount > AMOUNT_HIGH, "HIGH").when(amount > AMOUNT_MEDIUM, "MEDIUM").otherwise("LOW")
    )


def amount_bucket(amount: Column) -> Column:
    """Right-closed classes; nothing at or below zero."""
    return (
        F.when(amount > AMOUNT_HIGH, "HIGH").when(amount > AMOUNT_MEDIUM, "MEDIUM").when(amount > 0, "LOW")
    )


def is_high_amount(amount: Column) -> Column:
    return amount > LARGE_AMOUNT


def is_cross_border(region: Column, regions: Iterable[str] = CROSS_BORDER_REGIONS) -> Column:
    return F.coalesce(region.isin(*regions), F.lit(False))


def risk_level(score: Column) -> Column:
    """Left-closed classes: a score on a limit belongs to the class above."""
    return (
        F.when(score >= RISK_CRITICAL, "CRITICAL")
        .when(score >= RISK_HIGH, "HIGH")
        .when(score >= RISK_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )


def risk_category(score: Column) -> Column:
    """Right-closed classes over (0, 100]; null outside."""
    return (
        F.when((score > 0) & (score <= RISK_MEDIUM), "LOW")
        .when((score > RISK_MEDIUM) & (score <= RISK_HIGH), "MEDIUM")
        .when((score > RISK_HIGH) & (score <= RISK_CRITICAL), "HIGH")
        .when((score > RISK_CRITICAL) & (score <= 100), "CRITICAL")
    )


def severity(score: Column) -> Column:
    return F.when(score >= SEVERITY_CRITICAL, "critical").when(score >= SEVERITY_HIGH, "high")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts).isin(5, 6).cast("int")


def step_time(step: Column, base: str = "2024-01-01 00:00:00") -> Column:
    return F.timestamp_add("HOUR", step, F.lit(base).cast("timestamp"))


def type_channel(kind: Column) -> Column:
    pairs = [F.lit(x) for pair in TYPE_TO_CHANNEL.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), kind)


def padded_id(prefix: str, number: Column, digits: int) -> Column:
    """Zero-padded id; numbers with more digits keep all of them."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0")))


def high_risk_type(kind: Column) -> Column:
    return kind.isin("TRANSFER", "CASH_OUT")


def balance_discrepancy(old: Column, new: Column, amount: Column) -> Column:
    return F.abs(old - new - amount) > 1


def type_flags(kind: Column) -> dict[str, Column]:
    return {f"type_{t}": F.coalesce((kind == t).cast("int"), F.lit(0)) for t in PAYMENT_TYPES}


def finite_or_zero(value: Column) -> Column:
    value = value.cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, 0.0).otherwise(value)


def text_or_none(value: Column) -> Column:
    """A missing value inside a message reads `None`; a null would blank the whole message."""
    return F.coalesce(value, F.lit("None"))


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole in percent; zero when there is nothing to divide by."""
    return F.round(part * F.lit(100.0) / F.greatest(whole, F.lit(1)), digits)


def id_hash(ident: Column, seed: int) -> Column:
    """A repeatable 32-bit number per id, the same in every engine that knows MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), ident.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
