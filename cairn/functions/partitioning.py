"""Names, ranges and routing of time partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date patterns of a unit's suffix, plain and dashed; a quarter's number is appended.
PATTERNS = {
    "HOUR": ("yyyyMMddHH", "yyyy-MM-dd-HH"), "DAY": ("yyyyMMdd", "yyyy-MM-dd"), "MONTH": ("yyyyMM", "yyyy-MM"),
    "QUARTER": ("yyyy", "yyyy"), "YEAR": ("yyyy", "yyyy"),
}
_LEGAL = {
    "HOUR": (r"\d{10}", r"\d{4}-\d{2}-\d{2}-\d{2}"), "DAY": (r"\d{8}", r"\d{4}-\d{2}-\d{2}"), "MONTH": (r"\d{6}", r"\d{4}-\d{2}"),
    "QUARTER": (r"\d{4}[1-4]", r"\d{4}-[1-4]"), "YEAR": (r"\d{4}", r"\d{4}"),
}


def _unit(unit: str) -> str:
    if unit.upper() not in PATTERNS:
        raise ValueError(f"no such unit: {unit}")
    return unit.upper()


def suffix(ts: Column, unit: str, dashed: bool = False, zone: str | None = None) -> Column:
    """Suffix of the partition that holds a time; in ``zone`` if the time is an instant."""
    unit = _unit(unit)
    local = F.from_utc_timestamp(ts, zone) if zone else ts
    if unit == "QUARTER":
        return F.concat(F.date_format(local, PATTERNS[unit][dashed]), F.lit("-" if dashed else ""), F.quarter(local).cast("string"))
    return F.date_format(local, PATTERNS[unit][dashed])


def date_suffix(value: Column, compact: bool = False) -> Column:
    """Suffix from a DATE partition column; without dashes for compact day formats."""
    return F.date_format(value, "yyyyMMdd" if compact else "yyyy-MM-dd")


def start(text: Column, unit: str, dashed: bool = False) -> Column:
    """First moment of the partition with a suffix; null if the suffix is not legal."""
    unit = _unit(unit)
    digits = F.replace(text, F.lit("-"), F.lit(""))
    month = {"QUARTER": F.lpad((F.substring(digits, 5, 1).cast("int") * 3 - 2).cast("string"), 2, "0"), "YEAR": F.lit("01")}.get(unit, F.substring(digits, 5, 2))
    day = F.substring(digits, 7, 2) if unit in ("DAY", "HOUR") else F.lit("01")
    hour = F.substring(digits, 9, 2) if unit == "HOUR" else F.lit("00")
    built = F.concat(F.substring(digits, 1, 4), F.lit("-"), month, F.lit("-"), day, F.lit(" "), hour, F.lit(":00:00"))
    return F.when(is_legal(text, unit, dashed), built.try_cast("timestamp_ntz"))


def stop(text: Column, unit: str, dashed: bool = False) -> Column:
    """First moment after the partition with a suffix."""
    step = {"HOUR": "1 hour", "DAY": "1 day", "MONTH": "1 month", "QUARTER": "3 months", "YEAR": "1 year"}[_unit(unit)]
    return start(text, unit, dashed) + F.expr(f"interval {step}")


def next_suffix(text: Column, unit: str, dashed: bool = False) -> Column:
    return suffix(stop(text, unit, dashed), unit, dashed)


def is_legal(text: Column, unit: str, dashed: bool = False) -> Column:
    return text.rlike(f"^{_LEGAL[_unit(unit)][dashed]}$")


def child(parent: str, text: Column) -> Column:
    """Name of a child table."""
    return F.concat(F.lit(parent + "_"), text)


def route(df: DataFrame, parent: str, value: Column, existing: Sequence[str] | None = None, create: bool = False, action: str = "insert") -> DataFrame:
    """Rows with ``_child``, the table each goes to.

    Where a child is missing and may not be created an insert is an error, a get
    finds nothing (null) and a delete does nothing (the row is dropped).
    """
    name = child(parent, value.cast("string"))
    if existing is None or create:
        return df.withColumn("_child", name)
    known = name.isin(list(existing))
    if action == "insert":
        return df.withColumn("_child", F.when(known, name).otherwise(F.raise_error(F.concat(F.lit("no partition "), F.coalesce(name, F.lit("null")))).cast("string")))
    if action == "get":
        return df.withColumn("_child", F.when(known, name))
    if action == "delete":
        return df.where(known).withColumn("_child", name)
    raise ValueError(f"no such action: {action}")
