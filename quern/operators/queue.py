"""A leased work queue as table functions: eligibility, claim, outcome, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ATTEMPTS, LEASE = 4, "INTERVAL '120' SECOND"
# The answers of a server that are worth another try.
RETRY_STATUSES = [408, 425, 429, 500, 502, 503, 504]


def eligible(items: DataFrame, queue: str, now: Column) -> DataFrame:
    """Items of a queue that may be claimed: due, and pending or with a lease that ran out."""
    free = (F.col("status") == "PENDING") | ((F.col("status") == "LEASED") & (F.col("lease_expires_at") < now))
    return items.where((F.col("queue_name") == queue) & (F.col("available_at") <= now) & free)


def claim(items: DataFrame, queue: str, now: Column, n: int, owner: str) -> DataFrame:
    """The first n eligible items by id, leased to the owner, with one attempt more."""
    rows = eligible(items, queue, now).orderBy("id").limit(n)
    return rows.withColumn("status", F.lit("LEASED")).withColumn("attempts", F.col("attempts") + 1).withColumn("lease_owner", F.lit(owner)).withColumn("lease_expires_at", now + F.expr(LEASE))


def retry_delay(attempts: Column) -> Column:
    """Seconds: doubled with each attempt, five minutes at most."""
    return F.least(F.lit(300.0), F.pow(F.lit(2.0), F.greatest(F.lit(0), attempts - 1)))


def backoff_ceiling(attempt: Column) -> Column:
    """Seconds that a request's random delay stays under."""
    return F.least(F.lit(30.0), 0.5 * F.pow(F.lit(2.0), attempt - 1))


def retryable(status: Column) -> Column:
    return status.isin(RETRY_STATUSES)


def retry_after(header: Column, now: Column, attempt: Column) -> Column:
    """Seconds that a Retry-After header asks for (a number or an HTTP date), within 0 and 120; without a readable one, the ceiling of the random delay."""
    until = F.try_to_timestamp(F.regexp_replace(header, "^[A-Za-z]+, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    asked = F.coalesce(header.try_cast("double"), (F.unix_seconds(until) - F.unix_seconds(now)).cast("double"))
    return F.when(asked.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(120.0), asked))).otherwise(backoff_ceiling(attempt))


def dead_letters(items: DataFrame, stage: str, url: Column, error: Column) -> DataFrame:
    """One row per item (id, queue_name, status, attempts) that is dead: where it failed, on what, why, and the item itself."""
    payload = F.to_json(F.struct("id", "queue_name", "attempts"))
    return items.where("status = 'DEAD'").select("id", F.lit(stage).alias("stage"), url.alias("url"), F.substring_index(error, ": ", 1).alias("error_type"), F.substring_index(error, ": ", -1).alias("message"), payload.alias("payload"))


def run_metrics(items: DataFrame, run: str) -> DataFrame:
    """run_type, metrics (JSON): an append to the log of runs, from the items' states."""
    counts = items.groupBy(F.col(run).alias("run_type")).agg(
        F.count("*").alias("discovered"), F.count_if(F.col("attempts") > 0).alias("claimed"), F.count_if(F.col("status") == "DONE").alias("completed"),
        F.count_if(F.col("attempts") > 1).alias("retried"), F.count_if(F.col("status") == "DEAD").alias("dead"),
    )
    return counts.select("run_type", F.to_json(F.struct("discovered", "claimed", "completed", "retried", "dead")).alias("metrics"))


def transition(succeeded: Column, attempts: Column, owner: Column, claimed_by: Column) -> Column:
    """struct(status, delay) after work: done, due again later, or dead; only the lease's owner counts."""
    mine = owner == claimed_by
    status = F.when(~mine, "UNCHANGED").when(succeeded, "DONE").when(attempts < MAX_ATTEMPTS, "PENDING").otherwise("DEAD")
    return F.struct(status.alias("status"), F.when(status == "PENDING", retry_delay(attempts)).alias("delay"))


def unexpired(records: DataFrame, types: list[str], date: str, cutoff: Column) -> DataFrame:
    """Without the records of signal types dated before the cutoff; undated ones stay."""
    return records.where(~(F.col("record_type").isin(types) & F.coalesce(F.col(date) < cutoff, F.lit(False))))
