"""dedupe_latest against a brute-force model on random rows full of ties."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordersmith.operators import dedupe_latest
from ordersmith.sources.schema import UNIFIED, UNIFIED_COLUMNS

T0 = dt.datetime(2025, 1, 1)
TS = st.one_of(st.none(), st.sampled_from([T0, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(days=1)]))
ROW = st.fixed_dictionaries({
    "global_order_id": st.sampled_from([None, "amazon:A", "shopify:A", "amazon:B"]),
    "source_system": st.sampled_from(["amazon", "shopify"]),
    "order_created_at": TS,
    "order_processed_at": TS,
    "order_updated_at": TS,
    "ingested_at": TS,
    "order_status": st.sampled_from([None, "PAID", "SHIPPED", "pending"]),
    "order_total": st.sampled_from([None, Decimal("1.000000000"), Decimal("-2.500000000")]),
    "is_test": st.sampled_from([None, True, False]),
})


def as_tuple(d):
    return tuple(d.get(c) for c in UNIFIED_COLUMNS)


def desc_nulls_last(v):
    return (v is not None, v if v is not None else 0)


def model(rows):
    """Per id (NULL ids together): the row that is largest on the
    documented keys, then on every other column, each DESC NULLS LAST."""
    rest = [c for c in UNIFIED_COLUMNS if c not in ("global_order_id", "ingested_at")]

    def key(r):
        event = r["order_updated_at"] or r["order_processed_at"] or r["order_created_at"]
        return (desc_nulls_last(event), desc_nulls_last(r["ingested_at"]),
                *[desc_nulls_last(r.get(c)) for c in rest])

    groups = {}
    for r in rows:
        groups.setdefault(r["global_order_id"], []).append(r)
    return sorted((as_tuple(max(g, key=key)) for g in groups.values()), key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_dedupe_matches_model(spark, rows):
    df = spark.createDataFrame([as_tuple(r) for r in rows], UNIFIED).repartition(3)
    got = sorted((tuple(r[c] for c in UNIFIED_COLUMNS) for r in dedupe_latest(df).collect()), key=repr)
    assert got == model(rows)
