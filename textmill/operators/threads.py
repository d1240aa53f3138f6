"""Thread table from a message table: first and last messages per party, and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def thread_summary(
    messages: DataFrame,
    thread: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    member: str = "user",
    office: str = "assistant",
) -> DataFrame:
    """One row per thread; grouped min_by/max_by only, so long threads reduce before the shuffle."""
    by_member, by_office = F.col(role) == member, F.col(role) == office
    first_office = F.min(F.when(by_office, F.col(order)))
    first_member = F.min(F.when(by_member, F.col(order)))
    last_member = F.max(F.when(by_member, F.col(order)))
    last_office = F.max(F.when(by_office, F.col(order)))

    def first(column: str, condition):
        return F.min_by(F.when(condition, F.col(column)), F.when(condition, F.col(order)))

    return messages.groupBy(thread).agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min(order).alias("first_message_id"),
        F.min_by(text, order).alias("first_message_body"),
        F.min_by(role, order).alias("initiated_by"),
        first_member.alias("first_member_message_id"),
        first(text, by_member).alias("first_member_message_body"),
        first_office.alias("first_response_id"),
        first(text, by_office).alias("first_response_body"),
        F.max(order).alias("last_message_id"),
        F.max_by(text, order).alias("last_message_body"),
        F.coalesce(F.bool_or(by_member), F.lit(False)).alias("has_member_message"),
        F.coalesce(last_office > first_member, F.lit(False)).alias("has_response_to_member"),
        F.coalesce(last_member > first_office, F.lit(False)).alias("has_response_from_member"),
    )
