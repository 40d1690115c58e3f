from datetime import datetime

import pytest

from tidewire.operators import freshness

ROWS = [
    # id, url, published_at, content_length, extracted_at, in the two days, fresh by day
    ("in", "u", "2025-09-20T01:00:00Z", 0, datetime(2025, 1, 1), True, True),
    ("edge start", "u", "2025-09-18T17:00:00Z", 0, None, True, True),
    ("edge end", "u", "2025-09-20T17:00:00Z", 0, None, False, False),
    ("out but extracted in", "https://x/2025/09/20/a", "2025-09-01", 900, datetime(2025, 9, 20, 3), False, False),
    ("missing, dated url", "https://x/2025/09/20/a", None, None, datetime(2025, 9, 20, 3), True, True),
    ("missing, month url", "https://x/2025/09/a", "", 10, datetime(2025, 9, 20, 3), True, True),
    ("missing, long", "u", "soon", 200, datetime(2025, 9, 20, 3), True, True),
    ("missing, short", "u", "soon", 199, datetime(2025, 9, 20, 3), False, True),
    ("missing, extracted before", "u", None, 900, datetime(2025, 9, 17, 3), False, False),
    ("nothing", None, None, None, None, False, False),
]


@pytest.fixture(scope="module")
def arts(spark):
    return spark.createDataFrame(ROWS, "id string, url string, published_at string, content_length int, extracted_at timestamp_ntz, a boolean, b boolean")


def test_recent(arts):
    assert {r.id for r in freshness.recent(arts, "2025-09-20", "Asia/Ho_Chi_Minh", 2).collect()} == {r[0] for r in ROWS if r[5]}
    assert freshness.recent(arts.limit(0), "2025-09-20", "Asia/Ho_Chi_Minh").count() == 0


def test_fresh_by_day(arts):
    got = freshness.fresh_by_day(arts, "2025-09-20", "Asia/Ho_Chi_Minh", 2, "2025-09-20T17:00:00", 48).collect()
    assert {r.id for r in got} == {r[0] for r in ROWS if r[6]}


def test_window_over_a_clock_change():
    start, end, days = freshness.day_window("2025-11-02", "America/New_York", 1)
    assert (end - start) // 3_600_000_000 == 25 and days == ["2025-11-02"]
