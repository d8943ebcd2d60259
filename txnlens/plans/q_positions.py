"""Position queries: global row index, fixed-size batches, head, page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import position
from ..sources.tables import txn, with_views
from .catalog import register

POS_SQL = "row_number() OVER (ORDER BY Time, id) - 1"


@register("row_positions", "W1", with_views(f"SELECT id, {POS_SQL} AS pos FROM txn"))
def row_positions(spark, sf):
    return position.with_position(txn(spark, sf), ["Time", "id"]).select("id", "pos")


@register("row_batches", "W1 W2", with_views(f"""
SELECT id, CAST(floor(({POS_SQL}) / 100) AS BIGINT) AS batch_id FROM txn"""))
def row_batches(spark, sf):
    return position.row_batches(txn(spark, sf), 100).select("id", "batch_id")


@register("first_rows", "T3", with_views("""
SELECT id, Time, Amount, Class FROM txn ORDER BY Time, id LIMIT 20"""))
def first_rows(spark, sf):
    return position.head_rows(txn(spark, sf), 20).select("id", "Time", "Amount", "Class")


@register("page_rows", "T4", with_views("""
SELECT id, Time, Amount, Class FROM txn ORDER BY Time, id LIMIT 1000 OFFSET 1000"""))
def page_rows(spark, sf):
    return position.page(txn(spark, sf), 1000, 1000).select("id", "Time", "Amount", "Class")
