"""Data-quality detectors. Each returns (table_name, rule, record_key, detail), one row per finding.

They read the data and never change it; what silver repairs on its own is only reported here.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.cleaning import ISO_SPELLING, parse_moment, parse_number, stripped
from tillmark.operators.timeline import as_of

FINDING = ["table_name", "rule", "record_key", "detail"]


def record_key(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


class RowRule(NamedTuple):
    """A rule that looks at one row: where ``bad`` holds, the row is a finding with this detail."""

    name: str
    bad: Column
    detail: Column


def check_rows(df: DataFrame, table: str, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a table in one pass over it."""
    hits = [
        F.when(rule.bad, F.struct(F.lit(rule.name).alias("rule"), rule.detail.cast("string").alias("detail")))
        for rule in rules
    ]
    return df.select(record_key(key).alias("record_key"), F.explode(F.array_compact(F.array(*hits))).alias("hit")).select(
        F.lit(table).alias("table_name"), "hit.rule", "record_key", "hit.detail"
    )


def _findings(df: DataFrame, table: str, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        key.alias("record_key"),
        detail.cast("string").alias("detail"),
    )


def matching(df: DataFrame, table: str, key: Sequence[str], rule: RowRule) -> DataFrame:
    """One row rule; its condition becomes a filter that reaches the scan."""
    return _findings(df.where(rule.bad), table, rule.name, record_key(key), rule.detail)


def missing_value(column: str, only_if: Column | None = None) -> RowRule:
    """The column is NULL (where ``only_if`` holds)."""
    bad = F.col(column).isNull()
    return RowRule("missing_value", bad if only_if is None else bad & only_if, F.lit(column))


def padded_text(column: str) -> RowRule:
    """Raw text with white space at either end."""
    return RowRule("padded_text", F.col(column) != stripped(F.col(column)), F.lit(column))


def inconsistent_case(df: DataFrame, table: str, column: str) -> DataFrame:
    """Spellings that differ only in case: one finding per spelling group, with the number of spellings."""
    groups = df.where(F.col(column).isNotNull()).groupBy(F.lower(column).alias("_folded")).agg(
        F.count_distinct(column).alias("_spellings")
    )
    return _findings(
        groups.where("_spellings > 1"), table, "inconsistent_case", F.col("_folded"), F.col("_spellings")
    )


def duplicate_rows(raw: DataFrame, table: str, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows equal in all ``columns``: one finding per group, with its size.

    Groups form on a digest of the row, so wide text is not carried through the exchange.
    """
    # Length and NULL are part of the digested text, so different rows cannot spell the same.
    parts = [
        F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
        for c in columns
    ]
    groups = (
        raw.select(F.unhex(F.sha2(F.concat(*parts), 256)).alias("_digest"), record_key(key).alias("_key"))
        .groupBy("_digest", "_key")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    return _findings(groups.where("_copies > 1"), table, "duplicate_row", F.col("_key"), F.col("_copies"))


def number_format(column: str) -> RowRule:
    """A raw number written with a decimal comma, or not readable at all."""
    text = stripped(F.col(column))
    finite = F.abs(parse_number(F.col(column))) < F.lit(float("inf"))
    unreadable = (text != "") & ~F.coalesce(finite, F.lit(False))
    return RowRule(
        "number_format", text.contains(",") | unreadable, F.when(unreadable, "unreadable").otherwise("decimal_comma")
    )


def not_positive(column: str, zero_ok: bool = False) -> RowRule:
    """A raw measure that is negative, or zero unless zero is a legal value."""
    value = parse_number(F.col(column).cast("string"))
    return RowRule(
        "not_positive", value < 0 if zero_ok else value <= 0, F.when(value < 0, "negative").otherwise("zero")
    )


def out_of_bounds(column: str, low, high) -> RowRule:
    value = parse_number(F.col(column).cast("string"))
    return RowRule("out_of_bounds", ~value.between(low, high), F.lit(column))


def date_format_mix(column: str) -> RowRule:
    """A raw date that isn't written as ISO 8601 (found with the text), or not readable at all (`unreadable`)."""
    text = stripped(F.col(column))
    unreadable = (text != "") & parse_moment(F.col(column)).isNull()
    other = (text != "") & ~text.rlike(ISO_SPELLING)
    return RowRule("date_format", other, F.when(unreadable, "unreadable").otherwise(F.col(column)))


def unknown_value(column: str, domain: Sequence[str]) -> RowRule:
    """A value outside a closed list; NULL is not judged here."""
    return RowRule("unknown_value", ~F.col(column).isin(*domain), F.col(column))


def wrong_order(earlier: Column, later: Column) -> RowRule:
    """Two moments in the wrong order: the one that must come later is before the other."""
    return RowRule("wrong_order", later < earlier, later)


def orphan_reference(
    child: DataFrame, table: str, key: Sequence[str], fk: str, parent: DataFrame, pk: str
) -> DataFrame:
    """Rows whose reference has no parent; a NULL reference is not an orphan."""
    present = child.where(F.col(fk).isNotNull())
    orphans = present.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return _findings(orphans, table, "orphan_reference", record_key(key), F.col(fk))


def overlapping_periods(df: DataFrame, table: str, key: Sequence[str], start: str, end: str) -> DataFrame:
    """Periods (ends included) that begin before an earlier period is over, in (start, key) order.

    Only the latest end so far matters, so no pairs are formed. Periods are first reduced to one row per
    start; the running maximum then goes over the starts inside an hour, the hours inside a day and the days of
    the calendar.
    """
    periods = df.where(F.col(start) <= F.col(end)).select(
        record_key(key).alias("_key"), F.col(start).alias("_start"), F.col(end).alias("_end")
    )
    starts = (
        periods.groupBy("_start")
        .agg(F.max("_end").alias("_end"), F.min("_key").alias("_first_key"))
        .withColumns({"_hour": F.date_trunc("hour", "_start"), "_day": F.to_date("_start")})
    )
    earlier = (Window.unboundedPreceding, -1)
    in_hour = Window.partitionBy("_hour").orderBy("_start").rowsBetween(*earlier)
    in_day = Window.partitionBy("_day").orderBy("_hour").rowsBetween(*earlier)
    # One row per calendar day that has a start: small however many periods there are.
    over_days = Window.orderBy("_day").rowsBetween(*earlier)
    hours = starts.groupBy("_hour", "_day").agg(F.max("_end").alias("_end"))
    days = hours.groupBy("_day").agg(F.max("_end").alias("_end"))
    days = days.select("_day", F.max("_end").over(over_days).alias("_before_day"))
    hours = hours.select("_hour", "_day", F.max("_end").over(in_day).alias("_before_hour")).join(days, "_day")
    reach = (
        starts.withColumn("_same_hour", F.max("_end").over(in_hour))
        .join(hours.drop("_day"), "_hour")
        .select("_start", "_first_key", F.greatest("_same_hour", "_before_hour", "_before_day").alias("_reach"))
    )
    clashing = periods.join(reach, "_start").where(
        (F.col("_reach") >= F.col("_start")) | (F.col("_key") > F.col("_first_key"))
    )
    return _findings(clashing, table, "overlapping_period", F.col("_key"), F.col("_start"))


def _with_total(
    rows: DataFrame,
    order_key: str,
    items: DataFrame,
    item_order_key: str,
    item_amount: Column,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Rows with ``_total``, the sum over their order's items; items are summed before the join.

    With ``orders`` given, rows that refer to none of them are left out: those are orphans, another rule's finding.
    """
    totals = items.groupBy(F.col(item_order_key).alias(order_key)).agg(F.sum(item_amount).alias("_total"))
    known = rows.where(F.col(order_key).isNotNull())
    if orders is not None:
        known = known.join(orders.select(order_key), order_key, "left_semi")
    return known.join(totals, order_key, "left").withColumn("_total", F.coalesce("_total", F.lit(0)))


def amount_mismatch(
    payments: DataFrame,
    table: str,
    key: Sequence[str],
    order_key: str,
    amount: str,
    items: DataFrame,
    item_order_key: str,
    item_amount: Column,
) -> DataFrame:
    """Amounts that differ from the sum over the order's items, which is zero for an order without usable items.

    No other rule judges a payment's order, so payments of orders that aren't in the orders table are compared too.
    """
    joined = _with_total(payments, order_key, items, item_order_key, item_amount)
    return matching(joined, table, key, RowRule("amount_mismatch", F.col(amount) != F.col("_total"), F.col("_total")))


def price_drift(
    items: DataFrame,
    table: str,
    key: Sequence[str],
    product_key: str,
    price: str,
    sold_at: str,
    list_prices: DataFrame,
    list_price: str,
    valid_from: str,
) -> DataFrame:
    """Item prices that differ from the list price current at the time of the sale."""
    priced = as_of(items, sold_at, list_prices, valid_from, [product_key], list_price, "_list_price")
    drift = RowRule("price_drift", F.col(price) != F.col("_list_price"), F.col("_list_price"))
    return matching(priced, table, key, drift)


def points_mismatch(
    points: DataFrame,
    table: str,
    key: Sequence[str],
    order_key: str,
    earned: str,
    items: DataFrame,
    item_order_key: str,
    item_amount: Column,
    unit: int,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Earned points that are not one per full ``unit`` of the order's total, zero for an order without usable items."""
    due = F.floor(F.col("_total") / unit)
    joined = _with_total(points, order_key, items, item_order_key, item_amount, orders).withColumn("_due", due)
    return matching(joined, table, key, RowRule("points_mismatch", F.col(earned) != F.col("_due"), F.col("_due")))


def cost_ratio(
    costs: DataFrame,
    table: str,
    key: Sequence[str],
    product_key: str,
    cost: str,
    products: DataFrame,
    price: str,
    low: str,
    high: str,
) -> DataFrame:
    """Costs outside a share of the list price, compared without dividing."""
    joined = costs.join(products.select(product_key, F.col(price).alias("_price")), product_key)
    inside = F.col(cost).between(
        F.col("_price") * F.lit(low).cast("decimal(4,2)"), F.col("_price") * F.lit(high).cast("decimal(4,2)")
    )
    return matching(joined, table, key, RowRule("cost_ratio", ~inside, F.col("_price")))


def findings_per_rule(findings: DataFrame) -> DataFrame:
    return findings.groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("findings"))
