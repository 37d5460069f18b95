"""Lookups against small side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import null_if_empty


def first_named(*candidates: Column) -> Column:
    """First candidate that is neither null nor empty."""
    return F.coalesce(*[null_if_empty(c) for c in candidates])


def resolve_user(
    df: DataFrame, named: list[Column], uid_text: Column, users: DataFrame, into: str = "user"
) -> DataFrame:
    """User of a record: a named field, else the account of its uid on that host.

    An account table may name a uid twice; the first name in order counts.

    Hot ``(host, uid)`` pairs are split by AQE, and a measured-small account table is
    broadcast. Rows that have a name keep their uid in the join, so that they do not all
    meet in one null key.
    """
    uid = F.when(uid_text.rlike(r"^[+-]?[0-9]+$"), uid_text.try_cast("bigint"))
    accounts = users.groupBy("host_id", F.col("uid").cast("bigint").alias("__uid")).agg(
        F.min("username").alias("__username")
    )
    return (
        df.withColumn("__named", first_named(*named))
        .withColumn("__uid", uid)
        .join(accounts, ["host_id", "__uid"], "left")
        .withColumn(into, F.coalesce("__named", "__username", F.lit("")))
        .drop("__named", "__uid", "__username")
    )
