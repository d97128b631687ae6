"""Invariants from the test strategy, on the driver tables."""

SF = "/root/testdata/sf0.01"


def test_written_and_order_grain_agree_on_distincts_and_revenue(spark):
    from feria.plans import dashboard as D
    from feria.registry import star
    st = star(spark, SF)
    for flt in (D.Filters(), D.Filters(years=(1996, 1999), statuses=("delivered",))):
        w, b = D.kpi_row(st, flt).first(), D.kpi_row_by_order(st, flt).first()
        assert (w.total_orders, w.total_revenue, w.unique_buyers) == \
            (b.total_orders, b.total_revenue, b.unique_buyers)
        mw = {r.order_yearmonth: r.revenue for r in D.monthly(st, flt).collect()}
        mb = {r.order_yearmonth: r.revenue for r in D.monthly_by_order(st, flt).collect()}
        assert mw == mb


def test_incident_bounds(spark):
    from feria.plans import analytics as A
    from feria.registry import star
    r = A.q4_incident_rates(star(spark, SF)).first()
    parts = (r.canceled, r.late_deliveries, r.negative_reviews)
    assert max(parts) <= r.with_any_incident <= min(sum(parts), r.total_orders)


def test_clean_keys_unique_and_payments_positive(spark):
    from feria.registry import QUERIES
    rows = QUERIES["key_checks_clean"](spark, SF).collect()
    assert all(r.null_keys == 0 and r.duplicate_keys in (0, None) and r.not_positive in (0, None) for r in rows), rows


def test_star_matches_clean_and_fk_orphans_reported(spark):
    from feria.registry import QUERIES
    ver = {r.table: r for r in QUERIES["load_verification"](spark, SF).collect()}
    assert all(v.not_loaded == 0 for v in ver.values()), ver
    fk = {r.child: r for r in QUERIES["fk_orphans_star"](spark, SF).collect()}
    assert fk["fact_order_items.order_id"].orphans == 0
