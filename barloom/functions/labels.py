"""Signal labels for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the two oscillators.
RSI_OVERBOUGHT, RSI_OVERSOLD = 70, 30
MFI_OVERBOUGHT, MFI_OVERSOLD = 80, 20


def _oscillator(value: Column, high: float, low: float) -> Column:
    return (
        F.when(value > high, "overbought")
        .when(value < low, "oversold")
        .when(value.isNotNull(), "neutral")
    )


def rsi_label(value: Column) -> Column:
    return _oscillator(value, RSI_OVERBOUGHT, RSI_OVERSOLD)


def mfi_label(value: Column) -> Column:
    return _oscillator(value, MFI_OVERBOUGHT, MFI_OVERSOLD)


def return_label(value: Column, highest: Column) -> Column:
    """The best value wins over its sign; zero and NULL have no label colour."""
    return (
        F.when(value == highest, "highest")
        .when(value < 0, "negative")
        .when(value > 0, "positive")
        .otherwise("none")
    )
