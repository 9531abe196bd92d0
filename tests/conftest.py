import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starbazaar.session import local_session  # noqa: E402
from starbazaar.sources.schemas import RAW, STAR  # noqa: E402

SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "starbazaar-tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


def _value(text, kind):
    if text is None:
        return None
    if kind.startswith("timestamp") and isinstance(text, str):
        return datetime.fromisoformat(text)
    if kind.startswith("decimal"):
        return Decimal(str(text))
    if kind == "double":
        return float(text)
    return text


def raw_table(spark, name, rows):
    """A raw table from dicts; columns left out are NULL."""
    schema = RAW[name]
    data = [tuple(_value(r.get(f.name), f.dataType.simpleString()) for f in schema) for r in rows]
    return spark.createDataFrame(data, schema)


def star_table(spark, name, rows):
    """A star table from dicts; columns left out are NULL."""
    schema = STAR[name].schema
    data = [tuple(_value(r.get(f.name), f.dataType.simpleString()) for f in schema) for r in rows]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def raw(spark):
    """Three sound orders and the awkward ones around them."""
    def order(number, customer, bought, delivered=None, promised="2017-02-01", status="delivered"):
        return {"order_id": number, "customer_id": customer, "order_status": status,
                "order_purchase_timestamp": bought, "order_delivered_customer_date": delivered,
                "order_estimated_delivery_date": promised}

    def item(number, product="p1", seller="s1", price=10, freight=1, nth=1):
        return {"order_id": number, "order_item_id": nth, "product_id": product, "seller_id": seller,
                "price": price, "freight_value": freight}

    tables = {
        "orders": [
            order("o1", "c1", "2017-01-10T12:00:00", "2017-01-11T11:59:00"),
            order("o2", "c2", "2017-01-20T08:00:00", "2017-02-01T14:00:00"),
            order("o3", "c3", "2017-01-31T00:00:00", "2017-01-30T12:00:00", status="canceled"),
            order("no-time", "c1", None),
            order("early-promise", "c1", "2017-03-01T00:00:00"),
            order("stranger", "nobody", "2017-01-05T00:00:00"),
            order("no-customer", None, "2017-01-05T00:00:00"),
        ],
        "customers": [
            {"customer_id": f"c{n}", "customer_unique_id": "u1" if n < 3 else "u2", "customer_city": "x",
             "customer_state": "SP", "customer_zip_code_prefix": z}
            for n, z in ((1, "123"), (2, "123456"), (3, None))
        ],
        "order_items": [
            item("o1"), item("o1", nth=2),
            item("o2", "p2", price=20), item("o3"),
            item("no-time"), item("early-promise"), item("stranger"), item("no-customer"),
            item("o1", "p9", nth=3), item("o1", seller="s9", nth=4), item("o1", product=None, nth=5),
        ],
        "payments": [
            {"order_id": "o1", "payment_sequential": n, "payment_type": t, "payment_installments": n,
             "payment_value": v}
            for n, t, v in ((1, "boleto", 10), (2, "voucher", None), (3, "credit_card", 30), (4, "debit_card", 30))
        ],
        "reviews": [
            {"review_id": i, "order_id": "o1", "review_score": s, "review_answer_timestamp": t}
            for i, s, t in (("r3", 1, None), ("r2", 2, "2017-02-01T00:00:00"), ("r1", 5, "2017-02-02T00:00:00"))
        ],
        "products": [
            {"product_id": "p1", "product_category_name": "cama", "product_weight_g": 100},
            {"product_id": "p1", "product_category_name": "cama", "product_weight_g": 100},
            {"product_id": "p2", "product_category_name": "sem_nome"},
            {"product_id": "p3"},
        ],
        "sellers": [{"seller_id": "s1", "seller_city": "y", "seller_state": "RJ", "seller_zip_code_prefix": "7"}],
        "geolocation": [
            {"geolocation_zip_code_prefix": z, "geolocation_lat": v, "geolocation_lng": v and -v,
             "geolocation_city": c, "geolocation_state": "SP"}
            for z, v, c in (("1037", 1, None), ("01037", 2, "b"), ("1037", 3, "a"), ("1037", 10, "c"), ("5", None, "d"))
        ],
        "category_xlat": [{"product_category_name": "cama", "product_category_name_english": "bed"}],
    }
    return {name: raw_table(spark, name, rows) for name, rows in tables.items()}
