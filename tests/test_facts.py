import pytest

from brookhouse.operators import facts
from brookhouse.operators.changes import parse_changes, with_times
from tests.conftest import rows

CART = {"id": 11, "user_id": "u7", "sku_id": 5, "cart_price": 7.50, "sku_num": 3, "sku_name": "n",
        "is_checked": None, "create_time": "2023-11-14 22:13:20", "operate_time": None, "is_ordered": 0,
        "order_time": None}


@pytest.fixture
def log(lines):
    def make(*records):
        return with_times(parse_changes(lines(*[{"database": "shop", "ts": 1700000000} | r for r in records])))
    return make


def cart(kind, num, **old):
    record = {"table": "cart_info", "type": kind, "data": CART | {"sku_num": num}}
    return record | ({"old": old} if old else {})


def added(log, *records):
    return [r["sku_num"] for r in rows(facts.cart_adds(log(*records), "shop"))]


def test_cart_insert_counts_whole(log):
    (row,) = rows(facts.cart_adds(log(cart("insert", 1)), "shop"))
    assert row == {
        "id": "11", "user_id": "u7", "sku_id": "5", "cart_price": "7.5", "sku_num": "1", "sku_name": "n",
        "is_checked": None, "create_time": "2023-11-14 22:13:20", "operate_time": None, "is_ordered": "0",
        "order_time": None, "ts": 1700000000,
    }


def test_cart_ordering_is_no_add(log):
    assert added(log, cart("update", 1, is_ordered=0, order_time=None)) == []


def test_cart_increase_counts_the_difference(log):
    assert added(log, cart("update", 3, sku_num=1)) == ["2"]


def test_cart_decrease_same_and_delete_are_no_adds(log):
    assert added(log, cart("update", 2, sku_num=3), cart("update", 2, sku_num=2), cart("delete", 2)) == []


def test_cart_compares_numbers_not_texts(log):
    assert added(log, cart("update", "10", sku_num="9"), cart("update", "9", sku_num="10")) == ["1"]


def test_cart_unreadable_number_is_dropped(log):
    assert added(log, cart("update", "many", sku_num=1)) == []


def test_cancel_needs_the_transition(log):
    def order(before, after):
        return {"table": "order_info", "type": "update", "data": {"id": f"{before}-{after}", "order_status": after,
                "operate_time": "2024-01-01 10:00:00"}, "old": {"order_status": before} if before else {"x": 1}}

    got = rows(facts.order_cancels(log(order("1001", "1003"), order("1002", "1003"), order("1001", "1002"),
                                       order(None, "1003")), "shop"))
    assert [r["id"] for r in got] == ["1001-1003"]


def test_payment_needs_a_changed_status(log):
    def pay(i, status, **old):
        return {"table": "payment_info", "type": "update", "data": {"id": i, "payment_status": status}, "old": old}

    got = rows(facts.payments(log(pay(1, "1602", payment_status="1601"), pay(2, "1602", other=1),
                                  pay(3, "1603", payment_status="1601")), "shop"))
    assert [r["id"] for r in got] == ["1"]


@pytest.mark.parametrize("make, table", [
    (facts.comments, "comment_info"), (facts.order_detail_inserts, "order_detail"),
    (facts.order_info_inserts, "order_info"), (facts.activity_inserts, "order_detail_activity"),
    (facts.coupon_inserts, "order_detail_coupon"),
])
def test_inserts_of_one_table(log, make, table):
    data = {"id": 1, "order_detail_id": 1}
    records = [{"table": t, "type": k, "data": data} for t in (table, "other") for k in ("insert", "update", "delete")]
    foreign = {"database": "x", "table": table, "type": "insert", "data": data}
    assert make(log(*records, foreign), "shop").count() == 1
