"""Search history: the latest entry of a query stays; filters, orders and pages over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Orders a caller may ask for.
ORDERS = ("date_desc", "date_asc", "query_asc", "query_desc")


def latest(entries: DataFrame) -> DataFrame:
    """One row per user and query, case aside: the latest entry, of equals the one with the largest id."""
    newest = F.max(F.struct("created_at", "entry_id", "query")).alias("e")
    return entries.groupBy("user_id", F.lower("query").alias("key")).agg(newest).select("e.entry_id", "user_id", "e.query", "e.created_at")


def find(entries: DataFrame, user: int, term: str = "", first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    out = entries.where(F.col("user_id") == user)
    if term:
        out = out.where(F.col("query").ilike(f"%{term}%"))
    day = F.col("created_at").cast("date")
    if first_day:
        out = out.where(day >= F.lit(first_day).cast("date"))
    if last_day:
        out = out.where(day <= F.lit(last_day).cast("date"))
    return out


def order(name: str) -> list[Column]:
    """Sort keys by name; an unknown name means newest first. Ties by id."""
    keys = {"date_desc": F.col("created_at").desc(), "date_asc": F.col("created_at").asc(), "query_asc": F.lower("query").asc(), "query_desc": F.lower("query").desc()}
    return [keys.get(name, keys["date_desc"]), F.col("entry_id")]
