"""Translations and fallbacks as ``Column -> Column`` functions.

They stay inside whole-stage code generation, and cast explicitly wherever two types meet, so that
they hold under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Export source -> primary source.  Sources not listed pass through.
SOURCE_NAMES = {
    "Visual": "Visual",
    "Remote": "Remoto",
    "LocalRF": "LAN",
    "Optical": "Optical",
    "Manually Estimated": "Visual",
    "LegacySystem": "HES",
}

# Units that are renamed, per reading kind.
RESET_UNITS = {"Times": "Count"}
CONSUMPTION_UNITS = {"Degree": "°"}

# Measure name -> unit; any other measure has the unit "".
MEASURE_UNITS = {"Current": "A", "Voltage": "V", "Power Factor Angle": "°", "Frequency": "Hz"}


def relabel(value: Column, names: dict[str, str], otherwise: Column | None = None) -> Column:
    """Map the listed values; keep the rest, or give ``otherwise`` where it is set."""
    (first, label), *rest = names.items()
    mapped = F.when(value == first, F.lit(label))
    for name, label in rest:
        mapped = mapped.when(value == name, F.lit(label))
    return mapped.otherwise(value if otherwise is None else otherwise)


def primary_source(source: Column) -> Column:
    return relabel(source, SOURCE_NAMES)


def service_point(sdp_ident: Column, meter_irn: Column) -> Column:
    """The service delivery point, or the meter number where a meter has none."""
    return F.coalesce(sdp_ident, meter_irn.cast("string"))


def first_time(preferred: Column, fallback: Column) -> Column:
    return F.coalesce(preferred, fallback)


def reset_unit(unit: Column) -> Column:
    return relabel(unit, RESET_UNITS)


def consumption_unit(unit: Column) -> Column:
    return relabel(unit, CONSUMPTION_UNITS)


def measure_unit(name: Column) -> Column:
    return relabel(name, MEASURE_UNITS, otherwise=F.lit(""))


def status_value(value: Column) -> Column:
    """A raised status reads 0; magnitudes stay as they are."""
    return F.when(value == "true", F.lit("0")).otherwise(value)


def is_reported_status(value: Column) -> Column:
    """Statuses that are not raised ("false") are no readings; a missing value is one."""
    return ~value.eqNullSafe(F.lit("false"))


def spaced(*parts: Column) -> Column:
    """Parts joined by blanks; NULL when any part is NULL."""
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(" "), part]
    return F.concat(*joined)


def multiplier_text(ke: Column) -> Column:
    """The feed's multiplier text; NULL when ``ke`` is NULL."""
    # The text around ke, spacing included.
    return F.concat(F.lit("'MultiplierValues':{ 'ct': '', 'pt':'', 'ke':'"), ke, F.lit("', 'sf': ''}"))
