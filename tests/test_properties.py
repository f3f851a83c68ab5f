"""Random feeds against a plain-Python reading of the rules."""

from collections import defaultdict
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import EVENT, SHIPMENT, bag, rows
from waybill.operators import kpis, ranking
from waybill.operators.histogram import histogram
from waybill.operators.slicers import Selection, narrow
from waybill.plans import gold
from waybill.sources.serving import merged

START = datetime(2026, 5, 1)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

keys = st.sampled_from(["a", "b", "c", "d", None])
places = st.sampled_from(["X", "Y", None])
event = st.tuples(
    keys,
    st.sampled_from(["Picked Up", "Delivered", "Cancelled", "In Transit"]),
    st.integers(0, 12 * 86400 * 10).map(lambda tenths: START + timedelta(milliseconds=100 * tenths)),
    st.sampled_from(["H1", "H2", None]),
)
feeds = st.lists(event, max_size=25).map(
    lambda items: [(f"e{n:02d}", *item) for n, item in enumerate(items)]
)
shipments_by_key = st.dictionaries(
    st.sampled_from("abcd"),
    st.tuples(
        places, places, st.sampled_from([None, 1.0, 2.5]), st.sampled_from([None, 10.0, 20.25])
    ),
)


def frames(spark, shipped, tracked):
    shipments = [(key, *rest, date(2026, 5, 1)) for key, rest in shipped.items()]
    return spark.createDataFrame(shipments, SHIPMENT), spark.createDataFrame(tracked, EVENT)


@few
@given(shipped=shipments_by_key, tracked=feeds)
def test_gold_tables(spark, shipped, tracked):
    pair = frames(spark, shipped, tracked)

    def first(key, kind):
        return min((at for _, k, t, at, _ in tracked if k == key and t == kind), default=None)

    durations = {}
    for key in shipped:
        start, end = first(key, "Picked Up"), first(key, "Delivered")
        if start or end:
            known = start and end
            whole = known and end.replace(microsecond=0) - start.replace(microsecond=0)
            durations[key] = (start, end, whole.total_seconds() / 86400 if known else None)
    performance = gold.delivery_performance(*pair)
    assert set(
        rows(performance.select(
            "shipment_id", "picked_up_time", "delivered_time", "delivery_duration_days", "is_delayed"
        ))
    ) == {(key, s, e, d, None if d is None else d > 5) for key, (s, e, d) in durations.items()}

    latest = {}
    for event_id, key, kind, at, place in tracked:
        latest[key] = max(latest.get(key, (START - timedelta(1),)), (at, event_id, kind, place))
    expected = set()
    for key, (origin, destination, _, _) in shipped.items():
        at, _, kind, place = latest.get(key, (None,) * 4)
        expected.add((key, origin, destination, kind, place, at))
    snapshot = gold.shipment_snapshot(*pair)
    assert set(rows(snapshot)) == expected
    assert snapshot.count() == len(shipped)

    groups = defaultdict(list)
    for _, key, _, _, place in tracked:
        if key in shipped:
            origin, destination, weight, value = shipped[key]
            groups[origin, destination, place].append((weight, value))
    expected = {}
    for group, members in groups.items():
        weights = [w for w, _ in members if w is not None]
        values = [v for _, v in members if v is not None]
        expected[group] = (
            len(members),
            sum(values) if values else None,
            sum(weights) / len(weights) if weights else None,
        )
    routes = gold.route_optimization(*pair)
    assert {tuple(row[:3]): tuple(row[3:]) for row in routes.collect()} == expected

    row = kpis.kpis(snapshot, performance, routes).first()
    late = sum(1 for _, _, days in durations.values() if days is not None and days > 5)
    assert (row.total_shipments, row.delayed_shipments) == (len(shipped), late)
    assert row.on_time_pct == (100 * (1 - late / len(durations)) if durations else 0.0)
    assert row.value_at_risk == sum(value or 0 for _, value, _ in expected.values())
    counted = sum(n for _, n in rows(ranking.status_mix(snapshot)))
    assert counted == sum(1 for key in shipped if key in latest)

    both = narrow(narrow(performance, Selection(origin="X")), Selection(delay="Delayed"))
    assert bag(both) == bag(narrow(performance, Selection(origin="X", delay="Delayed")))


@few
@given(values=st.lists(st.one_of(st.none(), st.integers(-10**7, 10**7).map(lambda n: n / 86400))))
def test_histogram(spark, values):
    present = [value for value in values if value is not None]
    bins = rows(histogram(spark.createDataFrame([(v,) for v in values], "days double"), "days"))
    assert sum(n for _, _, n in bins) == len(present)
    assert len(bins) <= 20
    for start, end, n in bins:
        assert n == sum(start <= value < end for value in present)
    assert bins == sorted(bins)


@few
@given(
    held=st.dictionaries(keys, st.integers(0, 9)), new=st.dictionaries(keys, st.integers(0, 9))
)
def test_merge(spark, held, new):
    current, incoming = [
        spark.createDataFrame(list(items.items()), "k string, v long") for items in (held, new)
    ]
    once = merged(current, incoming, ["k"])
    assert dict(rows(once)) == {**held, **new}
    assert bag(merged(once, incoming, ["k"])) == bag(once)
