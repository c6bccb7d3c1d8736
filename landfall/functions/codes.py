"""Decoding and normalising of coded columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels by code; any other code, NULL included, is "Not Reported".
TRAVEL_MODES = {1: "Air", 2: "Sea", 3: "Land"}
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}
NOT_REPORTED = "Not Reported"


def _label(code: Column, labels: dict[int, str]) -> Column:
    branches = F
    for value, text in labels.items():
        branches = branches.when(code == value, text)
    return branches.otherwise(NOT_REPORTED)


def decode_mode(code: Column) -> Column:
    return _label(code, TRAVEL_MODES)


def decode_visa(code: Column) -> Column:
    return _label(code, VISA_CATEGORIES)


def whole(number: Column) -> Column:
    """Integer part; NULL where the value does not fit."""
    return number.try_cast("int")


def code_text(number: Column) -> Column:
    """Numeric code as text without padding: 54.0 becomes '54'."""
    return whole(number).cast("string")


def same_text(left: Column, right: Column) -> Column:
    """Case-insensitive equality; spaces count."""
    return F.upper(left) == F.upper(right)
