"""Table layouts. Every schema and cleaning expression is derived from these."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = "text"  # trimmed string, blank becomes NULL
MONEY = "money"  # non-negative decimal(18,4)
COUNT = "count"  # non-negative whole number
MOMENT = "moment"  # timestamp without zone

SILVER_TYPES = {
    TEXT: T.StringType(),
    MONEY: T.DecimalType(18, 4),
    COUNT: T.LongType(),
    MOMENT: T.TimestampNTZType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    columns: dict[str, str]
    bounds: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def attributes(self) -> list[str]:
        """The columns that are not part of the key."""
        return [c for c in self.columns if c not in self.key]

    def bronze_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType(fields + BRONZE_LINEAGE)

    def silver_schema(self) -> T.StructType:
        fields = [T.StructField(c, SILVER_TYPES[kind]) for c, kind in self.columns.items()]
        return T.StructType(fields + SILVER_LINEAGE)


# Where a raw row came from. (_loaded_at, _source_file, _block_start, _row_id) orders all versions of a key:
# load time first, then file name, then position inside the file.
BRONZE_LINEAGE = [
    T.StructField("_source_file", T.StringType()),
    T.StructField("_batch_ts", T.TimestampNTZType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
    T.StructField("_block_start", T.LongType()),
    T.StructField("_row_id", T.LongType()),
    T.StructField("_batch_id", T.LongType()),
]
SILVER_LINEAGE = [
    T.StructField("_source_file", T.StringType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
]
VERSION = ["_loaded_at", "_source_file", "_block_start", "_row_id"]

# The sixteen retail tables, their keys, column kinds and value bounds, in load order.
_SPECS = [
    TableSpec("categories", ("category_id",), {"category_id": TEXT, "category_name": TEXT}),
    TableSpec(
        "stores",
        ("store_id",),
        {"store_id": TEXT, "store_name": TEXT, "city": TEXT, "opened_date": MOMENT},
    ),
    TableSpec(
        "products",
        ("product_id",),
        {"product_id": TEXT, "product_name": TEXT, "category_id": TEXT, "unit_price": MONEY},
    ),
    TableSpec(
        "customers",
        ("customer_id",),
        {
            "customer_id": TEXT,
            "name": TEXT,
            "email": TEXT,
            "phone": TEXT,
            "city": TEXT,
            "join_date": MOMENT,
            "segment": TEXT,
        },
    ),
    TableSpec("suppliers", ("supplier_id",), {"supplier_id": TEXT, "supplier_name": TEXT, "city": TEXT}),
    TableSpec(
        "product_suppliers",
        ("product_id", "supplier_id"),
        {"product_id": TEXT, "supplier_id": TEXT, "cost_price": MONEY},
    ),
    TableSpec(
        "employees",
        ("employee_id",),
        {"employee_id": TEXT, "name": TEXT, "store_id": TEXT, "role": TEXT, "hire_date": MOMENT},
    ),
    TableSpec(
        "promotions",
        ("promo_id",),
        {
            "promo_id": TEXT,
            "promo_code": TEXT,
            "discount_pct": COUNT,
            "start_date": MOMENT,
            "end_date": MOMENT,
        },
        {"discount_pct": (0, 100)},
    ),
    TableSpec(
        "orders",
        ("order_id",),
        {
            "order_id": TEXT,
            "customer_id": TEXT,
            "store_id": TEXT,
            "order_date": MOMENT,
            "payment_method": TEXT,
            "status": TEXT,
        },
    ),
    TableSpec(
        "order_items",
        ("order_item_id",),
        {
            "order_item_id": TEXT,
            "order_id": TEXT,
            "product_id": TEXT,
            "quantity": COUNT,
            "unit_price": MONEY,
        },
    ),
    TableSpec(
        "payments",
        ("payment_id",),
        {
            "payment_id": TEXT,
            "order_id": TEXT,
            "method": TEXT,
            "amount": MONEY,
            "status": TEXT,
            "paid_at": MOMENT,
        },
    ),
    TableSpec(
        "shipments",
        ("shipment_id",),
        {
            "shipment_id": TEXT,
            "order_id": TEXT,
            "courier": TEXT,
            "shipped_date": MOMENT,
            "delivered_date": MOMENT,
            "status": TEXT,
        },
    ),
    TableSpec(
        "product_reviews",
        ("review_id",),
        {
            "review_id": TEXT,
            "customer_id": TEXT,
            "product_id": TEXT,
            "rating": COUNT,
            "review_text": TEXT,
            "review_date": MOMENT,
        },
        {"rating": (1, 5)},
    ),
    TableSpec("order_promotions", ("order_id", "promo_id"), {"order_id": TEXT, "promo_id": TEXT}),
    TableSpec(
        "support_tickets",
        ("ticket_id",),
        {
            "ticket_id": TEXT,
            "customer_id": TEXT,
            "order_id": TEXT,
            "issue_type": TEXT,
            "status": TEXT,
            "created_at": MOMENT,
        },
    ),
    TableSpec(
        "loyalty_points",
        ("loyalty_id",),
        {
            "loyalty_id": TEXT,
            "customer_id": TEXT,
            "order_id": TEXT,
            "points_earned": COUNT,
            "points_redeemed": COUNT,
        },
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}

# The tables every data set has; the others may be absent. Gold reads only these.
CORE = ("categories", "stores", "products", "customers", "orders", "order_items")
