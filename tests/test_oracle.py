"""Every registered core query against its SQL, or at least to its end, on the smallest tables."""

import pytest

from tests.compare import assert_same, duck
from tidewire.plans import crawl, digest, events, picks, pulse, quality, store, streams, texts, times, web

PLANS = (crawl, digest, events, picks, pulse, quality, store, streams, texts, times, web)
CASES = [(p, name) for p in PLANS for name in p.QUERIES]


@pytest.mark.parametrize(("plan", "name"), CASES, ids=[n for _, n in CASES])
def test_query(spark, sf_dir, plan, name):
    df = plan.QUERIES[name](spark, sf_dir)
    if name in plan.ORACLE:
        assert_same(df, duck(sf_dir).sql(plan.ORACLE[name]))
    else:
        df.collect()


def test_entry(spark, sf_dir):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
