"""Severity flag of the drift report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the flag rule: a resource is only judged when the control
# sum is above FLOOR; the relative drift |d|/control is compared (strictly)
# with the two thresholds.
FLOOR = 1000
LOW, HIGH = 0.125, 0.25
DOWN, DOWN2, UP, UP2 = "=", "==", "+", "++"


def drift_flag(control: Column, diff: Column) -> Column:
    """'' / '=' / '==' / '+' / '++' for a control sum and a signed difference."""
    ratio = F.abs(diff) / control  # control > FLOOR here, so no division by zero
    up = F.when(ratio > HIGH, UP2).when(ratio > LOW, UP).otherwise("")
    down = F.when(ratio > HIGH, DOWN2).when(ratio > LOW, DOWN).otherwise("")
    return (F.when(control > FLOOR, F.when(diff < 0, down).otherwise(up))
            .otherwise(""))
