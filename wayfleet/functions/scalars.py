"""Small typed rules: conversions, labels and traffic arithmetic, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfleet import schemas as S

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


# ---- repeatable draws ---------------------------------------------------
DRAW_DIGITS = 13


def slot_text(*slots) -> Column:
    """What a draw is taken from; a further slot may be added as ``:slot``."""
    return F.concat_ws(":", *[F.lit(x).cast("string") if not isinstance(x, Column) else x.cast("string") for x in slots])


def drawn_from(slots: Column) -> Column:
    """Integer of 52 bits that the text of the slots decides, from a digest any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(slots), 1, DRAW_DIGITS), 16, 10).cast("long")


def drawn(*slots) -> Column:
    return drawn_from(slot_text(*slots))


# ---- tolerant conversions ----------------------------------------------
def to_str(x, default: str = "") -> Column:
    value = _col(x)
    return F.coalesce(value.cast("string"), F.lit(default))


def to_float(x, default: float = 0.0) -> Column:
    return F.coalesce(_col(x).try_cast("double"), F.lit(default))


def to_int(x, default: int = 0) -> Column:
    """Truncates through a double, so ``'12.9'`` gives 12."""
    return F.coalesce(_col(x).try_cast("double").try_cast("int"), F.lit(default))


def to_bool(x, default: bool = False) -> Column:
    text = F.lower(F.trim(_col(x).cast("string")))
    return F.coalesce(text.isin("1", "true", "yes", "y"), F.lit(default))


def to_bool_strict(x) -> Column:
    """The narrower reading used when scoring orders: no ``y``, no trimming."""
    return F.coalesce(F.lower(_col(x).cast("string")).isin("1", "true", "yes"), F.lit(False))


def non_empty(x) -> Column:
    value = _col(x)
    return F.when(value != "", value)


# ---- identifiers --------------------------------------------------------
def edge_key(source, target) -> Column:
    return F.concat(F.lit("E_"), _col(source), F.lit("_"), _col(target))


def truck_id(number, width: int = 3) -> Column:
    return F.format_string(f"Truck_%0{width}d", _col(number))


def seed_customer_id(truck, position) -> Column:
    return F.format_string("Cust_T%03d_%d", _col(truck), _col(position))


def request_key(vehicle, now_ms) -> Column:
    return F.concat(F.lit("OPT_"), _col(vehicle), F.lit("_"), _col(now_ms).cast("string"))


def after_first_colon(key) -> Column:
    return F.regexp_replace(_col(key), "^[^:]*:", "")


def without_edge_prefix(key) -> Column:
    return F.regexp_replace(_col(key), "^edge:", "")


def short_truck_id(vehicle) -> Column:
    return F.regexp_replace(_col(vehicle), "(?i)^Truck_", "")


def number_in_id(vehicle) -> Column:
    digits = F.regexp_replace(_col(vehicle), r"\D", "")
    return F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


# ---- traffic arithmetic -------------------------------------------------
def travel_time_s(length_m, speed_kmh) -> Column:
    return _col(length_m) / 1000.0 / _col(speed_kmh) * 3600.0


def static_cost_s(length_m, max_speed_kmh) -> Column:
    """Seconds at the speed limit; a missing or zero value takes its default, speed is at least 1."""
    length = F.coalesce(F.when(_col(length_m) != 0, _col(length_m)), F.lit(1.0))
    speed = F.coalesce(F.when(_col(max_speed_kmh) != 0, _col(max_speed_kmh)), F.lit(S.DEFAULT_MAX_SPEED_KMH))
    return length / (F.greatest(speed, F.lit(1.0)) * 1000.0 / 3600.0)


def is_congested(avg_speed) -> Column:
    return _col(avg_speed) < S.STATE_CONGESTED_BELOW_KMH


def triggers_reroute(avg_speed, limit: float = S.REROUTE_AT_OR_BELOW_KMH) -> Column:
    speed = _col(avg_speed)
    return (speed > 0) & (speed <= limit)


def speed_class(avg_speed) -> Column:
    speed = _col(avg_speed)
    return (F.when(speed.isNull(), "none")
            .when(speed <= S.SLOW_CLASS_AT_OR_BELOW_KMH, "slow")
            .when(speed <= S.MEDIUM_CLASS_AT_OR_BELOW_KMH, "medium")
            .otherwise("fast"))


def heat_intensity(avg_speed) -> Column:
    return F.greatest(F.lit(0.0), 1 - _col(avg_speed) / 30)


def density_per_km(vehicles, length_m) -> Column:
    length = _col(length_m)
    return F.when(length > 0, _col(vehicles) / (length / 1000)).otherwise(F.lit(0.0))


def expected_speed(max_speed_kmh, density) -> Column:
    rho = _col(density)
    falling = _col(max_speed_kmh) * (1 - rho / S.JAM_DENSITY_PER_KM)
    return F.when(rho >= S.JAM_DENSITY_PER_KM, F.lit(S.CRAWL_SPEED_KMH)).otherwise(
        F.greatest(F.lit(S.CRAWL_SPEED_KMH), falling))


def edge_capacity(length_m) -> Column:
    return S.JAM_DENSITY_PER_KM * (_col(length_m) / 1000)


def display_speed(speed) -> Column:
    value = F.coalesce(_col(speed), F.lit(0.0))
    return F.when(value > 0, F.greatest(F.lit(3), F.round(value).cast("int"))).otherwise(F.lit(0))


# ---- times --------------------------------------------------------------
def iso_text(ts) -> Column:
    return F.coalesce(F.date_format(_col(ts), ISO_SECONDS), F.lit(""))


def epoch_ms(ts) -> Column:
    return F.coalesce(F.unix_millis(_col(ts)), F.lit(0).cast("long"))


def eta_text(seconds) -> Column:
    minutes = _col(seconds) / 60
    return (F.when(_col(seconds).isNull() | F.isnan(_col(seconds)), F.lit("—"))
            .when(minutes >= 10000, F.format_string("%.1f giờ", minutes / 60))
            .otherwise(F.format_string("%.1f phút", minutes)))


# ---- paths --------------------------------------------------------------
def split_path(path, position) -> tuple[Column, Column]:
    """(already driven, still ahead) at a zero-based position; all ahead without one."""
    p, at = _col(path), F.coalesce(_col(position), F.lit(0)).cast("int")
    return F.slice(p, F.lit(1), at), F.slice(p, at + 1, F.greatest(F.size(p) - at, F.lit(0)))
