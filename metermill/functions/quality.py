"""Interval quality flags -> standard quality codes.

A flag counts when its attribute is present, whatever its value, and the first rule that matches wins.
``quality_rule`` finds the position of that rule once; ``quality_codes`` looks the codes up by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QualityRule:
    flags: tuple[str, ...]
    system: str
    category: str
    index: str
    dst: str = ""


# The rules in order of precedence.
QUALITY_RULES = (
    QualityRule(("TimeChanged",), "2", "4", "9"),
    QualityRule(("ClockSetBackward",), "1", "4", "128"),
    QualityRule(("LongInterval",), "1", "4", "3"),
    QualityRule(("ClockSetForward",), "1", "4", "64"),
    QualityRule(("PartialInterval",), "1", "4", "2"),
    QualityRule(("InvalidTime",), "1", "1", "9"),
    QualityRule(("SkippedInterval",), "1", "4", "4"),
    QualityRule(("CompleteOutage",), "1", "2", "32"),
    QualityRule(("PulseOverflow",), "1", "4", "1"),
    QualityRule(("TestMode",), "1", "4", "5"),
    QualityRule(("Tamper",), "1", "3", "0"),
    QualityRule(("PartialOutage",), "1", "2", "32"),
    QualityRule(("SuspectedOutage", "Restoration"), "1", "2", "0"),
    QualityRule(("DST",), "1", "4", "16", dst="1"),
    QualityRule(("InvalidValue",), "2", "5", "256"),
)


def quality_rule(flags: Column) -> Column:
    """Position of the first rule one of whose flags is present; NULL when none is."""
    position = None
    for at, rule in enumerate(QUALITY_RULES):
        present = flags[f"_{rule.flags[0]}"].isNotNull()
        for flag in rule.flags[1:]:
            present = present | flags[f"_{flag}"].isNotNull()
        position = F.when(present, at) if position is None else position.when(present, at)
    return position


def quality_codes(rule: Column) -> dict[str, Column]:
    """The three codes and the DST status of a rule position; "" where it is NULL."""
    columns = {
        "dstStatus": [r.dst for r in QUALITY_RULES],
        "qualityCodesSystemId": [r.system for r in QUALITY_RULES],
        "qualityCodesCategorization": [r.category for r in QUALITY_RULES],
        "qualityCodesIndex": [r.index for r in QUALITY_RULES],
    }
    return {name: F.coalesce(F.get(F.expr(f"array({', '.join(map(repr, codes))})"), rule), F.lit(""))
            for name, codes in columns.items()}
