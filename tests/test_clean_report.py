"""The cleaning report is counted in flight: every raw row is read once."""

import pytest

from tradewind.functions import quantiles
from tradewind.operators import clean
from tradewind.plans.registry import retail


def watched(df, counter):
    """The same rows, each counted when it is read."""

    def work(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(work, df.schema)


@pytest.fixture(scope="module")
def raw(spark, small):
    return {n: df.persist() for n, df in retail(spark, small).all("raw_").items()}


def test_raw_tables_are_read_once(spark, raw):
    counters = {n: spark.sparkContext.accumulator(0) for n in clean.CLEANERS}
    cleaned, report = clean.clean_tables({n: watched(raw[n], c) for n, c in counters.items()})
    assert {n: c.value for n, c in counters.items()} == {n: raw[n].count() for n in counters}
    rows = report.collect()
    for name, df in cleaned.items():
        steps = [r for r in rows if r.table_name == name]
        assert steps[0].rows_before == raw[name].count() and steps[-1].rows_after == df.count()
        assert all(a.rows_after == b.rows_before for a, b in zip(steps, steps[1:]))
        assert all(r.rows_removed == r.rows_before - r.rows_after >= 0 for r in steps)
    assert [(r.table_name, r.step) for r in rows if r.table_name == "order_items"] == [
        ("order_items", s) for s in ("duplicates", "price outliers", "freight outliers")
    ]


def test_cleaned_tables_equal_the_cleaners(raw):
    cleaned, _ = clean.clean_tables({n: raw[n] for n in ("orders", "order_payments")})
    for name, df in cleaned.items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, clean.CLEANERS[name](raw[name]).collect()))


def test_a_count_that_does_not_fit_runs_the_chain_again(spark, monkeypatch):
    payments = spark.createDataFrame([(1, "card", 1, 2.0), (1, "card", 1, 2.0), (2, "card", 1, 0.0)],
                                     "order_id bigint, payment_type string, payment_installments bigint, payment_value double")
    whole, calls = clean.StepCounts.rows, []

    def twice_counted(self):
        calls.append(self)
        return [(t, s, b, a + (len(calls) == 1)) for t, s, b, a in whole(self)]

    monkeypatch.setattr(clean.StepCounts, "rows", twice_counted)
    _, report = clean.clean_tables({"order_payments": payments})
    assert [tuple(r) for r in report.collect()] == [("order_payments", "zero or negative", 3, 2, 1), ("order_payments", "duplicates", 2, 1, 1)]
    assert len(calls) == 2


ITEMS = "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, price double, freight_value double"


@pytest.mark.parametrize("rows", [
    [], [(1, 1, 1, 1, None, None)] * 2, [(1, k, 1, 1, None, float(k)) for k in range(9)],
    [(1, k, 1, 1, 5.0, None) for k in range(9)], [(None, k, None, 1, float("nan") if k % 4 == 0 else k * 1.0, 2.0) for k in range(9)] * 2,
    [(1, k, 1, 1, k * 1.0 if k else 1e6, k % 7 * 1.0 if k > 3 else -1e6) for k in range(200)],
])
def test_item_fences_of_odd_rows(spark, rows):
    """The bounds taken while the distinct rows are written give the fences that are found without them."""
    items = spark.createDataFrame(rows, ITEMS)
    cleaned = clean.clean_order_items(items)
    expected = clean.iqr_filter_chain(clean.dedup_full_row(items), ["price", "freight_value"])
    assert sorted(map(repr, cleaned.collect())) == sorted(map(repr, expected.collect()))


def test_items_are_read_twice_for_each_fence(spark, monkeypatch):
    """No pass looks for bounds, and two rounds end it."""
    rounds, counts = [], quantiles._counts
    monkeypatch.setattr(quantiles, "_counts", lambda *a: rounds.append([r.column for r in a[1]]) or counts(*a))
    frame = type(spark.range(0))
    passes, first = [], frame.first
    monkeypatch.setattr(frame, "first", lambda df: passes.append(df.columns) or first(df))
    rows = [(k, 1, 1, 1, k * 1.0 + 1e-6 * (k % 2), (k * 7919 % 5000) / 100) for k in range(5000)]
    assert 4500 < clean.clean_order_items(spark.createDataFrame(rows, ITEMS).repartition(3)).count() <= 5000
    assert [{*c} for c in rounds] == [{"price"}] * 2 + [{"freight_value"}] * 2
    assert all("price" not in columns for columns in passes)
