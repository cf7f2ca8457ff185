from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costflow.functions.epoch import epoch_to_ntz

# (input, expected text or None)
EDGES = [
    (1756684800, "2025-09-01 00:00:00"),
    (1756684800123, "2025-09-01 00:00:00"),
    (1756684800123456, "2025-09-01 00:00:00"),
    (1756684800123456789, "2025-09-01 00:00:00"),
    (1756684800999999999, "2025-09-01 00:00:00"),
    (999999999999, "2001-09-09 01:46:39"),
    (1, None),
    (-5, None),
    (-1756684800, None),
    (None, None),
    (4102444800, "2100-01-01 00:00:00"),
    (4102444801, None),
    (4102444800999, None),
    (4102444800000, "2100-01-01 00:00:00"),
    (946684800000, "2000-01-01 00:00:00"),
    (946684799999, None),
    (946684800, None),
    (999999999, None),
    (1000000000, "2001-09-09 01:46:40"),
    (946684800000000, None),
    (946684800000000000, None),
    (10**18, "2001-09-09 01:46:40"),
    (2**63 - 1, None),
]


def fixed(spark, values, **options):
    df = spark.createDataFrame(list(enumerate(values)), "n int, v bigint")
    rows = df.select("n", epoch_to_ntz("v", **options).alias("t")).collect()
    return [row.t for row in sorted(rows)]


def test_edges(spark):
    got = fixed(spark, [v for v, _ in EDGES])
    assert [t and str(t) for t in got] == [text for _, text in EDGES]


def test_session_zone_does_not_matter(spark, setting):
    setting("spark.sql.session.timeZone", "America/Los_Angeles")
    assert fixed(spark, [1756684800]) == [datetime(2025, 9, 1)]


def test_micros_keep_the_fraction(spark):
    values = [1756684800, 1756684800123, 1756684800123456, 1756684800123456789]
    micros = [0, 123000, 123456, 123456]
    assert fixed(spark, values, precision="micros") == [
        datetime(2025, 9, 1, microsecond=m) for m in micros
    ]


def test_not_strict_takes_shorter_numbers(spark):
    values = [946684800, 999999999, 946684800000000, 946684800000000000, 946684799]
    got = fixed(spark, values, strict=False)
    assert [t and str(t) for t in got] == [
        "2000-01-01 00:00:00",
        "2001-09-09 01:46:39",
        "2000-01-01 00:00:00",
        "2000-01-01 00:00:00",
        None,
    ]


def test_unknown_precision_is_refused():
    with pytest.raises(ValueError, match="precision"):
        epoch_to_ntz("v", precision="hours")


def by_digits(value):
    """The rule as worded: unit by number of digits, then the calendar guard."""
    per_second = {19: 10**9, 16: 10**6, 10: 1}.get(len(str(value)), 10**3)
    if not 946684800 * per_second <= value <= 4102444800 * per_second:
        return None
    origin = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (origin + timedelta(seconds=value // per_second)).replace(tzinfo=None)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(-(2**63), 2**63 - 1),
            *(
                st.integers(900_000_000 * unit, 4_200_000_000 * unit)
                for unit in (1, 10**3, 10**6, 10**9)
            ),
        ),
        min_size=50,
        max_size=200,
    )
)
def test_random_values(spark, values):
    assert fixed(spark, values) == [by_digits(v) for v in values]
