"""Column expressions.  Every function returns a ``Column``
built from ``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference for equal results) ----------
# Metric groups of the two sources.
WEATHER_METRICS = ("temperature", "humidity", "pressure", "wind_speed")
AIR_METRICS = ("aqi", "pm25", "pm10", "no2", "o3")
ALL_METRICS = WEATHER_METRICS + AIR_METRICS
# Validity range of the temperature flag, degrees Celsius.
TEMP_VALID_MIN, TEMP_VALID_MAX = -50, 60
# Default country code for a missing country.
DEFAULT_COUNTRY = "ND"
# Status labels.
STATUS_OK, STATUS_FAILED = "OK", "FAILED"
# Alert rule: strictly above this AQI.
ALERT_LIMIT = 100
ALERT_LABEL, NO_ALERT_LABEL = "ALERTE", "OK"
# AQI bands on the truncated mean: <=50, <=100, <=150, above.
AQI_BANDS = ((50, "Bon"), (100, "Modéré"), (150, "Mauvais pour groupes sensibles"))
AQI_BAND_TOP = "Mauvais"
# Wind sectors: right-closed 45-degree bins starting at 0 (0 itself falls
# outside every bin), labels in this order.
WIND_SECTORS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
# Run-type prefixes of batch ids.
SCHEDULED_PREFIX, MANUAL_PREFIX = "scheduled", "manual"
RUN_TYPE_SCHEDULED, RUN_TYPE_MANUAL = "Schedulé", "Manuel"
# Threshold verdict labels.
EXCEEDED_LABEL, WITHIN_LABEL = "DEPASSEMENT", "OK"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def all_null(cols) -> Column:
    """True when every column is NULL (no type coercion between them)."""
    return reduce(lambda a, b: a & b, [c(x).isNull() for x in cols])


def any_present(cols) -> Column:
    return ~all_null(cols)


def source_status(cols) -> Column:
    """FAILED only when all metrics of the group are missing."""
    return F.when(all_null(cols), F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_OK))


def range_flag(col, lo=TEMP_VALID_MIN, hi=TEMP_VALID_MAX) -> Column:
    """NULL counts as valid."""
    x = c(col)
    return x.isNull() | x.between(lo, hi)


def to_number(col, dtype: str = "double") -> Column:
    """text/number to a number; unparsable text and NaN become NULL."""
    x = c(col).cast("string").try_cast(dtype) if dtype else c(col)
    if dtype in ("double", "float"):
        x = F.when(~F.isnan(x), x)
    return x


def nan_to_null(col) -> Column:
    x = c(col)
    return F.when(~F.isnan(x), x)


def null_outside(col, lo=None, hi=None) -> Column:
    """Values outside [lo, hi] become NULL."""
    x = c(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= lo)
    if hi is not None:
        cond = cond & (x <= hi)
    return F.when(cond, x)


# ---- time ---------------------------------------------------------------

def hour_floor(ts) -> Column:
    """Truncate to the hour without leaving TIMESTAMP_NTZ (no zone)."""
    t = c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def slot_key(ts) -> Column:
    """Hour key YYYYMMDDHH as bigint."""
    return F.date_format(c(ts), "yyyyMMddHH").cast("bigint")


def slot_to_ts(slot) -> Column:
    """Hour key back to a timestamp (no zone)."""
    return F.to_timestamp_ntz(c(slot).cast("string"), F.lit("yyyyMMddHH"))


def utc_to_local(ts, zone: str = "Europe/Paris") -> Column:
    """UTC wall clock to local wall clock (both zone-less)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c(ts))


def weekend_flag(ts) -> Column:
    """Saturday or Sunday (weekday(): Monday = 0)."""
    return (F.weekday(c(ts)) >= 5).cast("int")


def cyclic(x, period: float):
    """(sin, cos) of 2*pi*x/period."""
    angle = c(x) * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def binarize(col) -> Column:
    """1 when strictly positive, a missing value counts as 0."""
    return (F.coalesce(c(col), F.lit(0)) > 0).cast("int")


def wind_sector(deg) -> Column:
    """Right-closed 45-degree sectors; 0 and values outside (0, 360]
    give NULL."""
    x = c(deg)
    idx = F.ceil(x / F.lit(45.0))
    labels = F.array(*[F.lit(s) for s in WIND_SECTORS])
    return F.when((x > 0) & (x <= 360), F.element_at(labels, idx.cast("int")))


def aqi_band(mean_col) -> Column:
    """Quality band of an (already truncated) mean AQI."""
    x = c(mean_col)
    expr = None
    for limit, label in AQI_BANDS:
        expr = F.when(x <= limit, F.lit(label)) if expr is None else expr.when(x <= limit, F.lit(label))
    return expr.otherwise(F.lit(AQI_BAND_TOP))


def alert_rule(col) -> Column:
    """Strictly above the limit raises an alert."""
    return F.when(c(col) > ALERT_LIMIT, F.lit(ALERT_LABEL)).otherwise(F.lit(NO_ALERT_LABEL))


def run_type(batch_col) -> Column:
    """Run type from the batch id prefix."""
    return F.when(c(batch_col).startswith(SCHEDULED_PREFIX),
                  F.lit(RUN_TYPE_SCHEDULED)).otherwise(F.lit(RUN_TYPE_MANUAL))


def threshold_verdict(value, limit) -> Column:
    """B23."""
    return F.when(c(value) > c(limit), F.lit(EXCEEDED_LABEL)).otherwise(F.lit(WITHIN_LABEL))


def pct_1dp(part, total) -> Column:
    """100 * part / total as DECIMAL(5,1) (exact decimal arithmetic,
    half-up), returned as double."""
    ratio = c(part).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") / c(total).cast("decimal(20,0)")
    return F.round(ratio, 1).cast("double")


def int_div_mean(sum_col, count_col) -> Column:
    """S3: integer mean as T-SQL computes AVG over an INT column
    (truncation toward zero)."""
    return F.expr(f"{sum_col} div {count_col}") if isinstance(sum_col, str) \
        else (c(sum_col) / c(count_col)).cast("long")


def decimal_mean(col, scale: int) -> Column:
    """Mean of a decimal column rounded half-up to ``scale`` digits (single
    rounding of the exact quotient), as double."""
    return F.round(F.sum(c(col)) / F.count(c(col)), scale).cast("double")
