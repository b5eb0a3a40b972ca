"""The whole run, in order: ingest, transform, dimensions, fact, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.plans.bronze import ingest_all
from tillmark.plans.gold import CALENDAR, TABLE_KEYS, Gold
from tillmark.plans.silver import Silver, transform_all
from tillmark.plans.upkeep import KeptViews
from tillmark.plans.views import all_views, create_views, register
from tillmark.session import configure_stored, side_by_side
from tillmark.specs import TABLES

STAR = ("dim_date", "dim_customer", "dim_store", "dim_product", "fact_sales")


def star_schema(gold: Gold) -> dict[str, DataFrame]:
    return {name: gold.read(name) for name in STAR}


def compact(spark: SparkSession, root: str) -> None:
    """Write the current state of every stored table as the start of later reads. Nothing does this on its own."""
    silver, gold = Silver(spark, root), Gold(spark, root)
    side_by_side(silver.compact, TABLES)
    side_by_side(lambda name: gold.table(name).compact(), TABLE_KEYS)


def stored_views(spark: SparkSession, root: str, calendar: tuple[str, str] = CALENDAR) -> dict[str, DataFrame]:
    """The views over the stored star schema, for readers in any later session."""
    star = star_schema(Gold(configure_stored(spark), root, calendar))
    create_views(star)
    return all_views(star)


def run(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    on_violation: str = "fail",
    calendar: tuple[str, str] = CALENDAR,
    kept_views: bool = False,
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Bring the warehouse below ``root`` up to date with the drops in ``raw_dir``.

    Returns ingest statistics, transform statistics and the views. Running again without new files
    changes nothing. With ``quarantine``, sales of a day outside the calendar are held back until a
    run with a calendar that has it; Gold.held_back() lists what is held back. With ``kept_views`` the views come from
    stored sums that take in what this run changed, else from the whole fact table when they are read.
    """
    configure_stored(spark)
    ingested = ingest_all(spark, root, raw_dir)
    transformed = transform_all(spark, root)
    gold = Gold(spark, root, calendar)
    gold.build_dims()
    gold.build_fact(on_violation)
    star = star_schema(gold)
    if kept_views:
        KeptViews(gold).refresh()
    found = KeptViews(gold).views(star) if kept_views else all_views(star)
    register(found)
    return ingested, transformed, found
