"""Per-user behaviour features. "Earlier" means the same user, before in (time, id) order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.functions import columns as c
from riskweave.functions.history import Measure, before, with_blocks
from riskweave.operators.joins import merchant_daily_counts, merchant_risk_asof
from riskweave.schemas import CROSS_BORDER_REGIONS, FEATURES

# Limits of the feature definitions.
MIN_HISTORY = 5
DAYS_BACK = 30
GEO_SCALE = 50.0
UNKNOWN_DEVICE = 0.8
SEQUENCE = 10

USER, ID, T = ["user_id"], "transaction_id", "_us"


def _history(df: DataFrame, measures: list[Measure], ts: str = "ts", **sizes: int) -> DataFrame:
    """Earlier-row totals per user; drops the helper time column again."""
    return before(df.withColumn(T, c.micros(F.col(ts))), USER, T, ID, measures, **sizes)


def _velocity(hours: int) -> Measure:
    return Measure("_velocity", F.lit(1), hours * c.HOUR)


def _recent(days: int, per: tuple[str, ...] = ()) -> Measure:
    return Measure("_recent_" + "_".join(("n", *per)), F.lit(1), days * c.DAY, True, per)


def _recent_amount(days: int) -> list[Measure]:
    """The sum of past amounts and how many there are; what is no money counts in neither."""
    paid = c.money(F.col("amount"))
    return [
        Measure("_recent_amount", paid, days * c.DAY, True),
        Measure("_recent_paid", F.when(paid.isNotNull(), 1), days * c.DAY, True),
    ]


def _recent_mean() -> Column:
    return F.try_divide(F.col("_recent_amount").cast("double"), F.col("_recent_paid"))


def _previous() -> Measure:
    return Measure("_previous", F.col(T), how="max")


def _geo(weight: str | None = None) -> list[Measure]:
    """Rows and positions added up; a row of `weight` n stands for n rows, and holds the sums of their positions."""
    return [Measure("_seen", F.lit(1) if weight is None else F.coalesce(F.col(weight), F.lit(1))), Measure("_lat", F.col("latitude")), Measure("_lng", F.col("longitude"))]


def _device(weight: str | None = None) -> Measure:
    """Uses of the row's device; a row that stands for several has no device, one of weight 0 is a known device."""
    used = F.lit(1) if weight is None else F.when(F.coalesce(F.col(weight), F.lit(0)) == 0, 1).otherwise(0)
    return Measure("_device_seen", used, per=("device_id",))


def _gap_score(previous: Column, ts: str) -> Column:
    """Seconds since `previous` as a share of a day, at most 1; 1 when there is none."""
    gap = (c.micros(F.col(ts)) - previous) / c.MICROS / 86400.0
    return F.coalesce(F.least(F.lit(1.0), gap), F.lit(1.0))


def _deviation() -> Column:
    count, amount, mean = F.col("_recent_n"), F.col("amount"), _recent_mean()
    score = F.try_divide(F.abs(amount - mean), mean)
    return F.when((count < MIN_HISTORY) | (mean == 0), 0.0).when(score > 1.0, 1.0).otherwise(score)


def _channel_share() -> Column:
    return F.coalesce(F.try_divide(F.col("_recent_n_channel"), F.col("_recent_n")), F.lit(0.0))


def _distance() -> Column:
    north = F.col("latitude") - F.try_divide("_lat", "_seen")
    east = F.col("longitude") - F.try_divide("_lng", "_seen")
    scaled = F.sqrt(north * north + east * east) / GEO_SCALE
    return F.when(scaled > 1.0, 1.0).otherwise(F.coalesce(scaled, F.lit(0.0)))


def _device_score() -> Column:
    return F.when(F.col("_device_seen") > 0, 0.0).otherwise(UNKNOWN_DEVICE)


def velocity(df: DataFrame, hours: int = 1, ts: str = "ts", **sizes: int) -> DataFrame:
    """Number of earlier transactions less than `hours` ago."""
    return _history(df, [_velocity(hours)], ts, **sizes).withColumnRenamed("_velocity", f"velocity_{hours}h")


def time_since_last_txn(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    rows = _history(df, [_previous()], ts, **sizes)
    return rows.withColumn("time_since_last_txn", _gap_score(F.col("_previous"), ts)).drop("_previous")


def time_since_second_last(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    """The variant that looks at the second-last earlier transaction of the past hour only."""
    once = _history(df, [_previous()], ts, **sizes)
    twice = _history(once, [Measure("_second", F.col("_previous"), how="max")], ts, **sizes)
    age = c.micros(F.col(ts)) - F.col("_second")
    return twice.withColumn(
        "time_since_prev2_1h", F.when(age < c.HOUR, _gap_score(F.col("_second"), ts)).otherwise(1.0)
    ).drop("_previous", "_second")


def amount_vs_avg(df: DataFrame, days: int = DAYS_BACK, ts: str = "ts", **sizes: int) -> DataFrame:
    """Relative deviation from the user's mean of the past days; 0 below five earlier rows."""
    rows = _history(df, [_recent(days), *_recent_amount(days)], ts, **sizes)
    return rows.withColumn("amount_vs_avg_30d", _deviation()).drop("_recent_n", "_recent_amount", "_recent_paid")


def amount_ratio(df: DataFrame, days: int = DAYS_BACK, ts: str = "ts", **sizes: int) -> DataFrame:
    """Amount over the user's mean of the past days; null without one."""
    rows = _history(df, _recent_amount(days), ts, **sizes)
    return rows.withColumn("amount_ratio_30d", F.try_divide("amount", _recent_mean())).drop("_recent_amount", "_recent_paid")


def channel_frequency(df: DataFrame, days: int = DAYS_BACK, ts: str = "ts", **sizes: int) -> DataFrame:
    rows = _history(df, [_recent(days), _recent(days, ("channel",))], ts, **sizes)
    return rows.withColumn("channel_frequency_score", _channel_share()).drop("_recent_n", "_recent_n_channel")


def geo_anomaly(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    """Distance from the mean of the user's earlier positions, scaled to at most 1."""
    rows = _history(df, _geo(), ts, **sizes)
    return rows.withColumn("geo_anomaly_score", _distance()).drop("_seen", "_lat", "_lng")


def device_match(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    rows = _history(df, [_device()], ts, **sizes)
    return rows.withColumn("device_fingerprint_match", _device_score()).drop("_device_seen")


def transaction_features(
    df: DataFrame,
    ts: str = "ts",
    cross_border: Iterable[str] = CROSS_BORDER_REGIONS,
    merchant_daily: DataFrame | None = None,
    keep: Iterable[str] = (),
    regions: DataFrame | None = None,
    weight: str | None = None,
    **sizes: int,
) -> DataFrame:
    """The 12 features in their fixed order, after the id and the columns in `keep`.

    All user features share one exchange. The merchant score joins a table of merchant-days. When
    the region comes from a lookup of users, pass it as `regions` (user_id, region): it is joined
    last, once, instead of below every pass over the rows. `weight` names a column that is null for
    ordinary rows and says how many rows a carry row stands for; those must be older than all look-backs.
    """
    measures = [
        _velocity(1), _recent(DAYS_BACK), *_recent_amount(DAYS_BACK), _recent(DAYS_BACK, ("channel",)),
        _previous(), *_geo(weight), _device(weight),
    ]
    wanted = [ID, "user_id", ts, "amount", "channel", "merchant", "region", "latitude", "longitude", "device_id", "is_fraud"]
    columns = [n for n in dict.fromkeys([*wanted, *keep, *([] if weight is None else [weight])]) if regions is None or n != "region"]
    daily = merchant_daily_counts(df, ts) if merchant_daily is None else merchant_daily
    scored = merchant_risk_asof(_history(df.select(*columns), measures, ts, **sizes), ts, daily=daily)
    if regions is not None:
        scored = scored.join(regions, "user_id", "left")
    features: dict[str, Column] = {
        "transaction_amount": F.col("amount"),
        "velocity_1h": F.col("_velocity"),
        "merchant_risk_score": F.col("merchant_risk_score"),
        "geo_anomaly_score": _distance(),
        "device_fingerprint_match": _device_score(),
        "time_since_last_txn": _gap_score(F.col("_previous"), ts),
        "amount_vs_avg_30d": _deviation(),
        "channel_frequency_score": _channel_share(),
        "hour_of_day": c.hour_of_day(F.col(ts)),
        "day_of_week": c.day_of_week(F.col(ts)),
        "is_high_amount": c.is_high_amount(F.col("amount")),
        "is_cross_border": c.is_cross_border(F.col("region"), cross_border),
    }
    others = [n for n in dict.fromkeys(keep) if n not in (ID, *FEATURES)]
    return scored.select(ID, *others, *[features[n].cast("double").alias(n) for n in FEATURES])


def sequence_window(df: DataFrame, names: Iterable[str] = FEATURES, length: int = SEQUENCE, ts: str = "ts", block: int = 4096,
                    keep: Iterable[str] = (), **sizes: int) -> DataFrame:
    """The previous `length` feature rows of the same user, oldest first, with the row's label and the columns `keep`.

    Rows with fewer earlier rows are left out. Frames run over blocks of consecutive rows of a
    user, so neither a window nor an array ever holds a whole long history.
    """
    names = list(names)
    blocks = _numbered_blocks(df, length, ts, block, **sizes)
    window = Window.partitionBy(*USER, "_block").orderBy("_position").rowsBetween(-length, -1)
    rows = blocks.withColumn("sequence", F.collect_list(F.array(*[F.col(n).cast("double") for n in names])).over(window))
    whole = ~F.col("_lead_in") & (F.size("sequence") == length) & F.col("_position").isNotNull()
    return rows.where(whole).select(ID, "user_id", "is_fraud", *keep, "sequence")


def sequence_rows(df: DataFrame, names: Iterable[str] = FEATURES, length: int = SEQUENCE, ts: str = "ts", block: int = 4096,
                  keep: Iterable[str] = (), **sizes: int) -> DataFrame:
    """What `sequence_window` tells, with every row's own features only, as the array `features`.

    A row `_whole` has its `length` earlier rows right before it in its partition; the rows of `sequence_window` are these.
    """
    blocks = _numbered_blocks(df, length, ts, block, **sizes).where(F.col("_position").isNotNull())
    whole = ~F.col("_lead_in") & (F.col("_position") >= length)
    placed = blocks.repartition(*USER, "_block").sortWithinPartitions(*USER, "_block", "_position")
    return placed.select(ID, "is_fraud", *keep, whole.alias("_whole"), F.array(*[F.col(n).cast("double") for n in names]).alias("features"))


def _numbered_blocks(df: DataFrame, length: int, ts: str, block: int, **sizes: int) -> DataFrame:
    numbered = _history(df, [Measure("_position", F.lit(1))], ts, **sizes)
    return with_blocks(numbered, USER, "_position", length, block)


def change_rate(df: DataFrame, field: str, name: str, ts: str = "ts", **sizes: int) -> DataFrame:
    """Share of the user's steps so far, this one included, on which `field` changed."""
    known = _history(df, [Measure("_before", F.col(field), how="last"), Measure("_steps", F.lit(1))], ts, **sizes)
    changed = F.when(F.col("_before") != F.col(field), 1).otherwise(0)
    rows = _history(known.withColumn("_changed", changed), [Measure("_changes", F.col("_changed"))], ts, **sizes)
    return rows.withColumn(
        name, F.coalesce(F.try_divide(F.col("_changes") + F.col("_changed"), F.col("_steps")), F.lit(0.0))
    ).drop("_before", "_steps", "_changed", "_changes")


def device_reuse(df: DataFrame) -> DataFrame:
    """How many different users the row's device was used by."""
    users = df.groupBy("device_id").agg(F.count_distinct("user_id").alias("device_users"))
    return df.join(users, "device_id")


def users_before(
    df: DataFrame, entity: str = "device_id", output: str = "device_users_before", ts: str = "ts", **sizes: int
) -> DataFrame:
    """How many different users had used the row's device (or another `entity`) before the row.

    Leak-free, unlike `device_reuse`: the first use by each user is a ledger entry of the device, and a
    row counts the entries before it. A device used by very many is split by time like any hot key. Rows
    without an entity have null, a missing user counts as one user.
    """
    timed = df.withColumn(T, c.micros(F.col(ts)))
    used = before(timed.where(F.col(entity).isNotNull()), [entity], T, ID, [Measure("_used", F.lit(1), per=("user_id",))], **sizes)
    fresh = F.when(F.col("_used") == 0, 1).otherwise(0)
    known = before(used, [entity], T, ID, [Measure(output, fresh)], **sizes).drop("_used", T)
    return known.unionByName(df.where(F.col(entity).isNull()).withColumn(output, F.lit(None).cast("long")))


def channel_diversity(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    """Different channels the user has used up to and including this row."""
    seen = _history(df, [Measure("_used", F.lit(1), per=("channel",))], ts, **sizes)
    fresh = seen.withColumn("_fresh", F.when(F.col("_used") == 0, 1).otherwise(0))
    rows = _history(fresh, [Measure("_kinds", F.col("_fresh"))], ts, **sizes)
    return rows.withColumn("channel_diversity", F.col("_kinds") + F.col("_fresh")).drop("_used", "_fresh", "_kinds")
