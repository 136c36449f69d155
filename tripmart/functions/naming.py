"""Column names: source spellings to the names used from the cleaned table on."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

# The trip columns, in source order, and the older spellings that stand for them.
TRIP_COLUMNS = (
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
)
OLD_SPELLINGS = {
    "starttime": "started_at",
    "stoptime": "ended_at",
    "startlon": "start_lng",
    "endlon": "end_lng",
    "usertype": "member_casual",
}

_BY_LETTERS = {column.replace("_", ""): column for column in TRIP_COLUMNS} | OLD_SPELLINGS


def canonical_name(name: str) -> str:
    """``"Start Station Name"`` and ``"startstationname"`` both give ``"start_station_name"``.

    Case, spaces and punctuation do not matter; unknown names become snake case.
    """
    words = re.findall(r"[a-z0-9]+", name.lower())
    return _BY_LETTERS.get("".join(words), "_".join(words))


def canonical_names(names: list[str]) -> list[str]:
    """Canonical names for a whole schema; a repeated one gets the first free ``_1``, ``_2``…"""
    taken: set[str] = set()
    result = []
    for name in map(canonical_name, names):
        unique, repeat = name, 0
        while unique in taken:
            repeat += 1
            unique = f"{name}_{repeat}"
        taken.add(unique)
        result.append(unique)
    return result


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*canonical_names(df.columns))


def merge_spellings(df: DataFrame) -> DataFrame:
    """``normalize_columns``, but all spellings of a trip column become one column: the first value there is.

    Files landed over the years spell the same column differently, and each has a value in its own.
    Unknown columns that end up with one name keep their numbered names.
    """
    places = [f"_{place}" for place in range(len(df.columns))]
    spelled: dict[str, list[str]] = {}
    for place, name in zip(places, df.columns):
        spelled.setdefault(canonical_name(name), []).append(place)
    columns = []
    for place, name, unique in zip(places, df.columns, canonical_names(df.columns)):
        canonical = canonical_name(name)
        if canonical not in TRIP_COLUMNS:
            columns.append(F.col(place).alias(unique))
        elif spelled[canonical][0] == place:
            columns.append(F.coalesce(*spelled[canonical]).alias(canonical))
    return df.toDF(*places).select(*columns)
