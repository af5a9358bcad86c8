from datetime import date

import pytest

from tidemark.operators import profile
from tidemark.plans.audit import assert_audit_clean, post_publish_audit, profile_lineitem


@pytest.fixture
def tables(spark):
    orders = spark.createDataFrame([(1, date(2026, 1, 2)), (2, date(2026, 1, 1))], "order_key LONG, order_date DATE")
    lines = spark.createDataFrame(
        [
            (1, 1, date(2026, 1, 1), date(2026, 1, 5), date(2026, 1, 3), "AIR", "N", "O"),
            (1, 2, date(2026, 1, 3), date(2026, 1, 5), date(2026, 1, 6), "SHIP", "R", "F"),
            (9, 1, date(2026, 1, 3), date(2026, 1, 5), date(2026, 1, 2), "AIR", None, "F"),
        ],
        "order_key LONG, line_number INT, ship_date DATE, commit_date DATE, receipt_date DATE, "
        "ship_mode STRING, return_flag STRING, line_status STRING",
    )
    return lines, orders


def test_post_publish_audit(tables):
    lines, orders = tables
    audit = {r.check_name: r.violations for r in post_publish_audit(lines, orders).collect()}
    assert audit == {
        "unexpected_ship_mode": 0, "unexpected_return_flag": 1, "unexpected_line_status": 0,
        "ship_before_order": 1, "receipt_before_ship": 1, "orphan_lineitems": 1, "orders_without_items": 1,
    }
    with pytest.raises(AssertionError, match="orphan_lineitems: 1"):
        assert_audit_clean(post_publish_audit(lines, orders))
    clean_lines = lines.filter("order_key = 1 AND line_number = 2")
    clean_orders = orders.filter("order_key = 1")
    assert_audit_clean(post_publish_audit(clean_lines, clean_orders))
    with pytest.raises(AssertionError, match="unexpected_ship_mode: 1"):
        assert_audit_clean(post_publish_audit(clean_lines.replace("SHIP", "CANOE"), clean_orders))
    plan = post_publish_audit(clean_lines, clean_orders)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_profile_suite(tables):
    lines, _ = tables
    p = profile_lineitem(lines)
    assert p["row_count"].first().row_count == 3
    assert p["null_counts"].first().return_flag == 1
    shares = {r.ship_mode: (r["count"], round(r.share_pct, 2)) for r in p["ship_mode_share"].collect()}
    assert shares == {"AIR": (2, 66.67), "SHIP": (1, 33.33)}
    assert [r.ship_mode for r in p["ship_mode_share"].collect()][0] == "AIR"  # most frequent first
    ranges = p["date_ranges"].first()
    assert (ranges.min_ship_date, ranges.max_receipt_date) == (date(2026, 1, 1), date(2026, 1, 6))
    transit = p["transit_summary"].first()
    assert (transit.min_transit_days, transit.max_transit_days) == (-1, 3)
    ipo = p["items_per_order"].first()
    assert (ipo.orders, ipo.min_items, ipo.max_items, ipo.mean_items) == (2, 1, 2, 1.5)
    rate = p["delay_rate"].first()
    assert (rate.total_items, rate.delayed_items, rate.delay_rate_pct) == (3, 1, 33.33)
    assert profile.preview(lines, 2).count() == 2


def test_unexpected_values_keep_null(tables):
    lines, _ = tables
    got = {(r.column_name, r.value) for r in profile.unexpected_values(lines, {"return_flag": ["N"], "ship_mode": ["AIR", "SHIP"]}).collect()}
    assert got == {("return_flag", "R"), ("return_flag", None)}
