import pytest
from hypothesis import given, strategies as st

from tripmart.functions.naming import (
    OLD_SPELLINGS,
    TRIP_COLUMNS,
    canonical_name,
    canonical_names,
    normalize_columns,
)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("started_at", "started_at"),
        ("Start Station Name", "start_station_name"),
        ("end_lng", "end_lng"),
        ("  Ride-ID ", "ride_id"),
        ("Stop Time", "ended_at"),
        ("USERTYPE", "member_casual"),
        ("start station latitude", "start_station_latitude"),
        ("Bike #", "bike"),
    ],
)
def test_canonical_name(name, expected):
    assert canonical_name(name) == expected


def test_every_trip_column_is_known_with_and_without_separators():
    for column in TRIP_COLUMNS:
        assert canonical_name(column) == canonical_name(column.replace("_", "")) == column
    for spelling, column in OLD_SPELLINGS.items():
        assert canonical_name(spelling) == column


def test_repeated_names_stay_apart():
    assert canonical_names(["starttime", "started_at", "Started At"]) == [
        "started_at",
        "started_at_1",
        "started_at_2",
    ]
    assert canonical_names(["a", "A", "a_1"]) == ["a", "a_1", "a_1_1"]


def test_values_stay_with_their_column(spark):
    df = spark.createDataFrame([("old", "new", "x")], ["starttime", "started_at", "v.1"])
    assert normalize_columns(df).first().asDict() == {"started_at": "old", "started_at_1": "new", "v_1": "x"}


@given(st.lists(st.text(alphabet="aA1 _-.é#", max_size=8), max_size=12))
def test_names_are_unique_and_stable(names):
    result = canonical_names(names)
    assert len(result) == len(names) == len(set(result))
    assert [canonical_name(canonical_name(name)) for name in names] == [canonical_name(name) for name in names]


@given(st.sampled_from(TRIP_COLUMNS), st.sampled_from(["", " ", "_", "-", " / "]), st.booleans())
def test_separators_and_case_do_not_matter(column, separator, upper):
    written = separator.join(column.split("_"))
    assert canonical_name(written.upper() if upper else written) == column
