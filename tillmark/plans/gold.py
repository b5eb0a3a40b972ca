"""Gold: the star schema over the core tables. The builders take and return DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.calendar import calendar_columns, date_key
from tillmark.operators.integrity import References, flag_broken, reference_violations, split_by_references
from tillmark.plans.silver import BUCKETS, Silver
from tillmark.session import STORED, no_rows
from tillmark.sources.folders import adopt, any_match, last_finished, last_with_gaps
from tillmark.sources.keyed_table import KeyedTable
from tillmark.specs import CORE

# First and last day of the calendar, and the layouts of the star schema.
CALENDAR = ("2015-01-01", "2035-12-31")
DIM_DATE = (
    "date_key int, full_date date, year int, quarter int, month int, month_name string, day int, "
    "day_name string, is_weekend boolean"
)
DIM_CUSTOMER = (
    "customer_id string, name string, email string, phone string, city string, segment string, "
    "join_date timestamp_ntz, _loaded_at timestamp_ntz"
)
DIM_STORE = (
    "store_id string, store_name string, city string, opened_date timestamp_ntz, _loaded_at timestamp_ntz"
)
DIM_PRODUCT = (
    "product_id string, product_name string, category_id string, category_name string, "
    "unit_price decimal(18,4), _loaded_at timestamp_ntz"
)
FACT_SALES = (
    "order_item_id string, order_id string, date_key int, customer_id string, product_id string, "
    "store_id string, payment_method string, order_status string, quantity bigint, "
    "unit_price decimal(18,4), line_amount decimal(18,4), _loaded_at timestamp_ntz"
)
# Touched orders that a refresh names in its filters at most; more are joined.
NAMED_ORDERS = 5_000
DIMENSIONS = ("dim_date", "dim_customer", "dim_product", "dim_store")
TABLE_KEYS = {
    "dim_customer": ("customer_id", DIM_CUSTOMER),
    "dim_store": ("store_id", DIM_STORE),
    "dim_product": ("product_id", DIM_PRODUCT),
    "fact_sales": ("order_item_id", FACT_SALES),
}


class BrokenReferenceError(ValueError):
    """A fact row refers to a dimension row that does not exist."""


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d")
    return spark.range(1).select(days).select(*calendar_columns(F.col("d")))


def _project(df: DataFrame, layout: str) -> DataFrame:
    return df.select(T.StructType.fromDDL(layout).names)


def dim_customer(customers: DataFrame) -> DataFrame:
    return _project(customers, DIM_CUSTOMER)


def dim_store(stores: DataFrame) -> DataFrame:
    return _project(stores, DIM_STORE)


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category's name, NULL when there is none. The version is the product's own."""
    names = categories.select("category_id", "category_name")
    return _project(products.join(names, "category_id", "left"), DIM_PRODUCT)


def fact_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order item of a complete sale."""
    items = order_items.where("quantity IS NOT NULL AND unit_price IS NOT NULL")
    heads = orders.where(
        "order_date IS NOT NULL AND customer_id IS NOT NULL AND store_id IS NOT NULL"
    ).withColumnRenamed("_loaded_at", "_order_loaded_at")
    sales = items.drop("_source_file").join(heads.drop("_source_file"), "order_id")
    return sales.select(
        "order_item_id",
        "order_id",
        date_key(F.col("order_date")).alias("date_key"),
        "customer_id",
        "product_id",
        "store_id",
        "payment_method",
        F.col("status").alias("order_status"),
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)").alias("line_amount"),
        F.greatest("_loaded_at", "_order_loaded_at").alias("_loaded_at"),
    )


def fact_references(dims: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str]]:
    """Which dimension each foreign key of the fact points to."""
    return {
        "date_key": (dims["dim_date"], "date_key"),
        "customer_id": (dims["dim_customer"], "customer_id"),
        "product_id": (dims["dim_product"], "product_id"),
        "store_id": (dims["dim_store"], "store_id"),
    }


@dataclass(frozen=True)
class Gold:
    spark: SparkSession
    root: str
    calendar: tuple[str, str] = CALENDAR
    buckets: int = BUCKETS

    @property
    def _silver(self) -> Silver:
        return Silver(self.spark, self.root, self.buckets)

    def table(self, name: str) -> KeyedTable:
        key, layout = TABLE_KEYS[name]
        schema = T.StructType.fromDDL(layout)
        return KeyedTable(self.spark, f"{self.root}/gold/{name}", (key,), schema)

    def read(self, name: str) -> DataFrame:
        return dim_date(self.spark, *self.calendar) if name == "dim_date" else self.table(name).read()

    def _mark(self, step: str) -> dict[str, int]:
        """Last silver run per core table this step has processed."""
        path = f"{self.root}/control/gold/step={step}"
        run = last_finished(self.spark, path, "run")
        if run < 0:
            return dict.fromkeys(CORE, -1)
        return {r.table_name: r.silver_run for r in self.spark.read.parquet(f"{path}/run={run}").collect()}

    def _set_mark(self, step: str, marks: dict[str, int]) -> None:
        path = f"{self.root}/control/gold/step={step}"
        run = last_finished(self.spark, path, "run") + 1
        rows = self.spark.createDataFrame(list(marks.items()), "table_name string, silver_run bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")

    def _silver_runs(self) -> dict[str, int]:
        silver = self._silver
        return {name: silver.last_run(name) for name in CORE}

    def _merge(self, name: str, rows: DataFrame) -> None:
        table = self.table(name)
        table.merge(rows, table.last_run() + 1)

    def build_dims(self) -> None:
        """Upsert into the dimensions the silver rows changed since the last build."""
        silver = self._silver
        done, now = self._mark("dims"), self._silver_runs()
        moved = {name: now[name] > done[name] for name in CORE}

        def changed(name: str) -> DataFrame:
            return silver.changes(name, after=done[name])

        if moved["customers"]:
            self._merge("dim_customer", dim_customer(changed("customers")))
        if moved["stores"]:
            self._merge("dim_store", dim_store(changed("stores")))
        if moved["products"] or moved["categories"]:
            products = silver.read("products")
            if not moved["categories"]:
                products = changed("products")
            elif done["products"] >= 0:
                # A renamed category touches all its products, changed or not.
                renamed = changed("categories").select("category_id")
                touched = products.join(renamed, "category_id", "left_semi").select("product_id")
                touched = touched.unionByName(changed("products").select("product_id")).distinct()
                products = products.join(touched, "product_id", "left_semi")
            self._merge("dim_product", dim_product(products, silver.read("categories")))
        if any(moved.values()):
            self._set_mark("dims", now)

    def _changed_sales(self, done: dict[str, int]) -> DataFrame:
        """Fact rows of every order that changed, or had an item change, since the last build, and all that are held back.

        What is held back of other orders is what their join would give again: it is taken as it was written.
        """
        silver = self._silver
        items, orders = silver.read("order_items"), silver.read("orders")
        if done["orders"] < 0:
            return fact_sales(items, orders)
        changed = silver.changes("order_items", after=done["order_items"]).select("order_id", "order_item_id")
        touched = silver.changes("orders", after=done["orders"]).select("order_id")
        touched = touched.unionByName(changed.select("order_id")).distinct()
        held_back = self._held_back()
        if held_back is None:
            return self._joined_sales(items, orders, touched)
        # An item may have moved to another order, which alone is touched by that.
        still = held_back.join(touched, "order_id", "left_anti").join(changed, "order_item_id", "left_anti")
        return self._joined_sales(items, orders, touched).unionByName(still.select(held_back.columns))

    @staticmethod
    def _joined_sales(items: DataFrame, orders: DataFrame, touched: DataFrame) -> DataFrame:
        """Fact rows of the touched orders."""
        few = [r.order_id for r in touched.limit(NAMED_ORDERS + 1).collect()]
        if len(few) <= NAMED_ORDERS:
            # Named in the plan, they open only their buckets of a compacted table, and of the files only row groups
            # that may hold them.
            mine = F.col("order_id").isin(few)
            return fact_sales(items.where(mine), orders.where(mine))
        return fact_sales(
            items.join(touched, "order_id", "left_semi"), orders.join(touched, "order_id", "left_semi")
        )

    def held_back(self) -> DataFrame:
        """Sales that broken references keep out of the fact table for now."""
        pending = self._held_back()
        return no_rows(self.spark, FACT_SALES) if pending is None else pending

    def _held_back(self) -> DataFrame | None:
        path = f"{self.root}/gold/fact_sales_quarantine"
        run = last_with_gaps(self.spark, path, "run")
        if run < 0:
            return None
        return self.spark.read.schema(FACT_SALES).parquet(f"{path}/run={run}").select(
            T.StructType.fromDDL(FACT_SALES).names
        )

    def build_fact(self, on_violation: str = "fail") -> None:
        """Upsert the sales changed since the last build.

        A broken reference fails the whole build and the same sales are tried again next time; with
        ``quarantine`` only the rows at fault are held back, and retried with every later build.
        """
        done, now = self._mark("fact"), self._silver_runs()
        pending = self._held_back()
        if done == now and (pending is None or pending.isEmpty()):
            return
        table = self.table("fact_sales")
        run = table.last_run() + 1
        references = fact_references({name: self.read(name) for name in DIMENSIONS})
        if on_violation == "quarantine" and done["orders"] < 0 and pending is None:
            self._first_fact(run, references)
            self._set_mark("fact", now)
            return
        # The join is written out once, in place of the last build's; checks read it back column by column.
        staged = self._staged
        self._changed_sales(done).write.options(**STORED).mode("overwrite").parquet(staged)
        sales = self.spark.read.schema(FACT_SALES).parquet(staged)
        # Sales are joined from the current state of silver: none can be older than the row it replaces.
        if on_violation == "quarantine":
            sales, broken = split_by_references(sales, references)
            table.merge(sales, run, guard=False)
        else:
            example = reference_violations(sales, references).first()
            if example is not None:
                raise BrokenReferenceError(
                    f"fact_sales.{example.fk} = {example.key_value!r} has no dimension row "
                    f"({example.row_count} fact rows)"
                )
            # All sales that were held back are among these: none is left.
            broken = None if pending is None else no_rows(self.spark, FACT_SALES)
            # Nothing is taken away from them: they become the run as they are.
            table.merge(sales, run, guard=False, written=staged)
        # After the merge: a build cut off before this still finds what it had to retry.
        if broken is not None:
            broken.write.options(**STORED).mode("overwrite").parquet(self._quarantine(run))
        self._set_mark("fact", now)

    @property
    def _staged(self) -> str:
        return f"{self.root}/gold/fact_sales_staged"

    def _quarantine(self, run: int) -> str:
        return f"{self.root}/gold/fact_sales_quarantine/run={run}"

    def _first_fact(self, run: int, references: References) -> None:
        """The first build with quarantine: every sale is written once, where it stays.

        Keys are looked up in the columns of silver that sales take them from, before the join.
        """
        items, orders = self._silver.read("order_items"), self._silver.read("orders")
        heads = orders.select(date_key(F.col("order_date")).alias("date_key"), "customer_id", "store_id")
        sources = {fk: items if fk == "product_id" else heads for fk in references}
        flagged = flag_broken(fact_sales(items, orders), references, "_held", sources)
        flagged.write.options(**STORED).partitionBy("_held").mode("overwrite").parquet(self._staged)
        table = self.table("fact_sales")
        written = {held: f"{self._staged}/_held={held}" for held in ("false", "true")}
        there = {held: any_match(self.spark, folder) for held, folder in written.items()}
        # Without rows there is no folder.
        table.merge(table.empty(), run, guard=False, written=written["false"] if there["false"] else None)
        # After the merge, as in every build.
        if there["true"]:
            adopt(self.spark, written["true"], self._quarantine(run))
        else:
            no_rows(self.spark, FACT_SALES).write.mode("overwrite").parquet(self._quarantine(run))
