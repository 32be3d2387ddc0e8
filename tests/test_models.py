from decimal import Decimal

from pyspark.testing import assertDataFrameEqual

from shopmarts.plans.intermediate import order_money
from shopmarts.plans.marts import stage
from tests.conftest import LOAD, at


def test_lines_roll_up_per_order(spark):
    lines = spark.createDataFrame(
        [(1, 10, 1, 2, 1000, 100), (2, 10, 2, 1, 500, 0), (3, 11, 1, 3, 1000, 300)],
        "order_item_id long, order_id long, product_id long, quantity int,"
        "unit_price_cents long, discount_cents long",
    )
    expected = spark.createDataFrame(
        [(10, 2, 3, 2500, 100, 2400), (11, 1, 3, 3000, 300, 2700)],
        "order_id long, line_item_count long, units long, gross_amount_cents long,"
        "discount_cents long, net_amount_cents long",
    )
    assertDataFrameEqual(order_money(lines), expected)


def test_staging_renames_and_lowers(source):
    staged = stage(source.raw(customers=[{"id": 1}]))
    row = staged["stg_webshop__customers"].first()
    assert (row.customer_id, row.email, row.customer_segment, row.dlt_load_id) == (
        1,
        "c1@example.be",
        "consumer",
        LOAD,
    )
    assert "_dlt_id" not in row.asDict()
    assert [len(table.columns) for table in staged.values()] == [12, 12, 12, 7]


def test_an_order_without_lines_keeps_its_row(source):
    marts = source.marts(customers=[{"id": 1}], orders=[{"id": 10}])
    order = marts.orders.first()
    assert (order.line_item_count, order.units, order.net_amount_eur) == (0, 0, Decimal("0.00"))
    customer = marts.customers.first()
    assert customer.has_ordered and customer.lifetime_order_count == 1
    assert customer.lifetime_realised_net_revenue_eur == Decimal("0.00")
    assert marts.order_items.count() == 0


def test_an_orphan_line_vanishes(source):
    marts = source.marts(orders=[{"id": 10}], order_items=[{"id": 1, "order_id": 99}])
    assert marts.order_items.count() == 0
    assert marts.orders.first().net_amount_eur == 0


def test_customers_who_never_ordered_or_only_cancelled(source):
    marts = source.marts(
        customers=[{"id": 1}, {"id": 2}],
        orders=[{"id": 10, "customer_id": 2, "status": "cancelled"}],
        order_items=[{"id": 1, "order_id": 10}],
    )
    for row in marts.customers.collect():
        assert row.has_ordered is False
        assert row.lifetime_order_count == 0
        assert row.lifetime_realised_net_revenue_eur == Decimal("0.00")
        assert row.first_order_at is None


def test_a_null_status_is_revenue_but_no_lifetime_order(source):
    marts = source.marts(
        customers=[{"id": 1}],
        orders=[{"id": 10, "status": None}],
        order_items=[{"id": 1, "order_id": 10}],
    )
    order, line = marts.orders.first(), marts.order_items.first()
    for row in (order, line):
        assert row.is_cancelled is None
        assert row.order_status_label is None
        assert row.realised_net_amount_eur == row.net_amount_eur == Decimal("10.00")
    assert order.is_delivered is None
    assert marts.customers.first().has_ordered is False


def test_cancelled_money_is_booked_not_realised(source):
    marts = source.marts(
        orders=[{"id": 10, "status": "cancelled"}],
        order_items=[{"id": 1, "order_id": 10, "quantity": 2, "discount_cents": 150}],
    )
    for row in (marts.orders.first(), marts.order_items.first()):
        assert row.net_amount_eur == Decimal("18.50")
        assert row.realised_net_amount_eur == Decimal("0.00")
        assert row.gross_amount_eur == Decimal("20.00")
        assert row.discount_eur == Decimal("1.50")
        assert row.is_cancelled is True


def test_days_to_ship_follow_the_shipping_time_alone(source):
    ordered = at("2026-03-01 10:59")
    marts = source.marts(
        orders=[
            {"id": 1, "ordered_at": ordered, "shipped_at": at("2026-03-02 11:01")},
            {"id": 2, "ordered_at": ordered, "status": "cancelled", "shipped_at": at("2026-03-01 11:01")},
            {"id": 3, "ordered_at": ordered, "status": "shipped"},
            {"id": 4, "ordered_at": ordered, "shipped_at": at("2026-02-28 10:00")},
        ]
    )
    days = {row.order_id: row.days_to_ship for row in marts.orders.collect()}
    assert days == {1: 25 / 24, 2: 1 / 24, 3: None, 4: -1.0}
    assert marts.orders.schema["days_to_ship"].dataType.simpleString() == "double"


def test_names_and_labels(source):
    marts = source.marts(
        customers=[{"id": 1, "last_name": None, "segment": "business"}],
        products=[{"id": 1}, {"id": 2, "sku": "0000000000099"}],
        orders=[{"id": 10, "channel": "mobile_app"}],
    )
    customer = marts.customers.first()
    assert customer.full_name is None and customer.segment_label == "Business"
    names = {row.product_name for row in marts.products.collect()}
    assert names == {"Ethiopia · Light roast · Beans 250g"}
    product = marts.products.first()
    assert (product.unit_price_eur, product.unit_cost_eur, product.unit_margin_eur) == (
        Decimal("14.50"),
        Decimal("6.50"),
        Decimal("8.00"),
    )
    assert marts.orders.first().channel_label == "Mobile app"


def test_an_expensive_line_does_not_overflow(source):
    marts = source.marts(
        orders=[{"id": 10}],
        order_items=[{"id": 1, "order_id": 10, "quantity": 2**20, "unit_price_cents": 2**31 - 1}],
    )
    assert marts.orders.first().net_amount_eur == Decimal(2**20 * (2**31 - 1)) / 100


def test_column_counts(source):
    widths = {name: len(table.columns) for name, table in source.marts().named().items()}
    assert widths == {
        "fct_orders": 21,
        "fct_order_items": 16,
        "dim_customers": 15,
        "dim_products": 15,
    }
