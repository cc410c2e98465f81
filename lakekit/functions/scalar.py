"""Column expressions; all run inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Country of a store; a store not listed belongs to the default country.
STORE_COUNTRY = {
    "AKL01": "NZ", "AKL02": "NZ", "BNE02": "AU", "CBR01": "AU", "MEL01": "AU", "MEL02": "AU",
    "PER02": "AU", "SYD01": "AU", "SYD02": "AU", "BNE01": "AU", "WLG01": "NZ",
}
DEFAULT_COUNTRY = "AU"


def lookup(key: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Value of a small literal map; keys not listed give the default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, key)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def store_country(store_id: Column) -> Column:
    return lookup(store_id, STORE_COUNTRY, DEFAULT_COUNTRY)


def case_in(col: Column, groups: Mapping[str, list[str]]) -> Column:
    """CASE WHEN col IN (...) THEN ...; values in no group give NULL."""
    out = None
    for value, members in groups.items():
        out = F.when(col.isin(members), value) if out is None else out.when(col.isin(members), value)
    return out


def busy_time(day: Column, hour: Column, holiday: Column | None = None) -> Column:
    """Weekends, December to February and holidays are busy 10-14 and 16-19 h, other days 11-12 and 16-17 h."""
    free = (F.weekday(day) >= 5) | F.month(day).isin(12, 1, 2)
    if holiday is not None:
        free = free | holiday
    return (free & (hour.between(10, 14) | hour.between(16, 19))) | hour.between(11, 12) | hour.between(16, 17)


def with_holiday(df: DataFrame, holidays: DataFrame, day: str, country: str, out: str = "is_holiday") -> DataFrame:
    """Mark rows whose day is a bank holiday of their country; ``holidays`` has columns country and date."""
    h = holidays.select(F.col("country").alias("_hc"), F.col("date").alias("_hd")).distinct()
    j = df.join(h, (df[country] == h["_hc"]) & (df[day].cast("date") == h["_hd"]), "left")
    return j.withColumn(out, F.col("_hd").isNotNull()).drop("_hc", "_hd")


def calendar(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end`` of every row, both included."""
    return df.select("*", F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))).alias(out))


def backfill_start(day: Column, months: int) -> Column:
    """``months`` back, rolled to the start of a month; a day that already is one goes a month further back."""
    back = F.add_months(day, -months)
    start = F.trunc(back, "MM")
    return F.when(F.dayofmonth(back) == 1, F.add_months(start, -1)).otherwise(start)


def last_days(ts: Column, as_of, days: int = 7) -> Column:
    """``ts`` within the last days before ``as_of`` (default use: now)."""
    return ts >= F.date_add(F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of, -days)


def hex_byte(x: Column) -> Column:
    """Two hex digits of a number clamped to 0..255."""
    return F.lpad(F.hex(F.least(F.greatest(F.lit(0), x), F.lit(255))), 2, "0")


def h_concentration(ph: Column) -> Column:
    """Hydrogen ion concentration of a pH value."""
    return F.lit(1.0) / F.pow(F.lit(10.0), ph)


def log_ratio(a: Column, b: Column) -> Column:
    """ln(a / b); NULL where the ratio is not positive or b is zero."""
    r = F.try_divide(a, b)
    return F.when(r > 0, F.ln(r))


def composite_id(*parts: Column, sep: str = "-") -> Column:
    """Parts joined to one id; NULL when any part is NULL (``concat_ws`` would skip it)."""
    out = []
    for i, p in enumerate(parts):
        out += [F.lit(sep), p.cast("string")] if i else [p.cast("string")]
    return F.concat(*out)
