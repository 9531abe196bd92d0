"""Raw table schemas and the star schema with its constraints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
TIME = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
SMALL = T.ShortType()
#: The reject reason of a row that is part of the fact.
KEPT = "none"
#: The raw keys that the reject report shows.
REJECT_KEYS = ("order_id", "customer_id", "product_id", "seller_id")


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


RAW: dict[str, T.StructType] = {
    "orders": _schema(
        order_id=TEXT, customer_id=TEXT, order_status=TEXT, order_purchase_timestamp=TIME, order_approved_at=TIME,
        order_delivered_carrier_date=TIME, order_delivered_customer_date=TIME, order_estimated_delivery_date=TIME),
    "customers": _schema(
        customer_id=TEXT, customer_unique_id=TEXT, customer_zip_code_prefix=TEXT, customer_city=TEXT,
        customer_state=TEXT),
    "order_items": _schema(
        order_id=TEXT, order_item_id=T.IntegerType(), product_id=TEXT, seller_id=TEXT, shipping_limit_date=TIME,
        price=T.DecimalType(18, 2), freight_value=T.DecimalType(18, 2)),
    "payments": _schema(
        order_id=TEXT, payment_sequential=T.IntegerType(), payment_type=TEXT, payment_installments=T.IntegerType(),
        payment_value=T.DecimalType(18, 2)),
    "reviews": _schema(
        review_id=TEXT, order_id=TEXT, review_score=T.IntegerType(), review_creation_date=TIME,
        review_answer_timestamp=TIME),
    "products": _schema(
        product_id=TEXT, product_category_name=TEXT, product_weight_g=T.DoubleType(),
        product_length_cm=T.DoubleType(), product_height_cm=T.DoubleType(), product_width_cm=T.DoubleType()),
    "sellers": _schema(seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT),
    "geolocation": _schema(
        geolocation_zip_code_prefix=TEXT, geolocation_lat=T.DoubleType(), geolocation_lng=T.DoubleType(),
        geolocation_city=TEXT, geolocation_state=TEXT),
    "category_xlat": _schema(product_category_name=TEXT, product_category_name_english=TEXT),
}


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    comment: str = ""


@dataclass(frozen=True)
class Table:
    name: str
    comment: str
    columns: tuple[Col, ...]
    primary_key: str
    unique: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)
    checks: dict[str, tuple[str, Callable[[Column], Column]]] = field(default_factory=dict)
    generated_key: bool = True

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, c.type, True, {"comment": c.comment} if c.comment else None) for c in self.columns
        ])


def _text(name: str, length: int, required: bool = False, comment: str = "") -> Col:
    return Col(name, TEXT, required, length, comment)


STAR: dict[str, Table] = {t.name: t for t in (
    Table(
        "dim_date", "Calendar days that occur in the orders.",
        (
            Col("date_key", T.IntegerType(), True, comment="Day as YYYYMMDD."),
            Col("full_date", T.DateType(), True),
            *(Col(name, SMALL, True) for name in ("year", "quarter", "month")),
            _text("month_name", 10, True),
            Col("week", SMALL, True, comment="ISO week, 1 to 53."),
            Col("day", SMALL, True),
            Col("day_of_week", SMALL, True, comment="ISO weekday, Monday is 1."),
            _text("day_name", 10, True),
            Col("is_weekend", T.BooleanType(), True, comment="True on Saturday and Sunday."),
        ),
        primary_key="date_key", generated_key=False,
    ),
    Table(
        "dim_customer", "One row per customer_id, the identity used for a single purchase.",
        (
            Col("customer_key", T.LongType(), True),
            _text("customer_id", 50, True, "Identity of one purchase."),
            _text("customer_unique_id", 50, True, "The person behind one or more purchases."),
            _text("city", 100), _text("state", 2, True), _text("zip_code_prefix", 5),
        ),
        primary_key="customer_key", unique=("customer_id",),
    ),
    Table(
        "dim_product", "Products with their category in both languages.",
        (
            Col("product_key", T.LongType(), True),
            _text("product_id", 50, True), _text("category_name_pt", 100),
            _text("category_name_en", 100, comment="English name from the translation table."),
            Col("weight_g", MONEY),
            *(Col(name, T.DecimalType(8, 2)) for name in ("length_cm", "height_cm", "width_cm")),
        ),
        primary_key="product_key", unique=("product_id",),
    ),
    Table(
        "dim_seller", "Sellers of the marketplace.",
        (
            Col("seller_key", T.LongType(), True),
            _text("seller_id", 50, True), _text("city", 100), _text("state", 2, True), _text("zip_code_prefix", 5),
        ),
        primary_key="seller_key", unique=("seller_id",),
    ),
    Table(
        "dim_location", "One row per zip code prefix.",
        (
            Col("location_key", T.LongType(), True),
            _text("zip_code_prefix", 5, True), _text("city", 100), _text("state", 2, True),
            Col("lat", T.DecimalType(9, 6), comment="Median latitude of the prefix."),
            Col("lng", T.DecimalType(9, 6), comment="Median longitude of the prefix."),
        ),
        primary_key="location_key", unique=("zip_code_prefix",),
    ),
    Table(
        "fact_orders", "One row per order item.",
        (
            Col("order_key", T.LongType(), True),
            _text("order_id", 50, True, "Order number kept on the fact for drill-through."),
            *(Col(name, T.LongType(), True) for name in ("customer_key", "product_key", "seller_key")),
            Col("date_key", T.IntegerType(), True, comment="Day of purchase."),
            _text("order_status", 20, True),
            Col("price", MONEY, True), Col("freight_value", MONEY, True),
            Col("payment_value", MONEY, comment="Largest payment of the order, repeated on each of its items."),
            _text("payment_type", 30), Col("payment_installments", SMALL),
            Col("review_score", SMALL, comment="Score of the order's latest answered review."),
            Col("delivery_days", SMALL, comment="Whole days from purchase to delivery; empty when unknown."),
            Col("estimated_delivery_days", SMALL, True, comment="Whole days from purchase to the promised date."),
            Col("is_late_delivery", T.BooleanType(), comment="Delivered after the promise; empty when unknown."),
        ),
        primary_key="order_key",
        foreign_keys={"customer_key": "dim_customer", "product_key": "dim_product", "seller_key": "dim_seller",
                      "date_key": "dim_date"},
        checks={
            "price_not_negative": ("price", lambda c: c >= 0),
            "freight_not_negative": ("freight_value", lambda c: c >= 0),
            "review_score_range": ("review_score", lambda c: c.between(1, 5)),
            "installments_not_negative": ("payment_installments", lambda c: c >= 0),
        },
    ),
)}

# Dimensions come before the fact that points at them.
LOAD_ORDER = list(STAR)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in order, cast to their declared types.

    A value outside its type becomes NULL here; the domain checks in ``operators.constraints`` look at the
    columns before this cast and report it.
    """
    return df.select(*(
        F.col(c.name).try_cast(c.type).alias(c.name, metadata={"comment": c.comment}) if c.comment
        else F.col(c.name).try_cast(c.type).alias(c.name)
        for c in table.columns
    ))
