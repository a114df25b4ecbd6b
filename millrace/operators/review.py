"""Two-stage review: transitions and reports over the review history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.intervals import latest_before


def transition(action: Column, actor: Column, status: Column, labeled: Column, note: Column) -> Column:
    """State after an action; one that isn't allowed leaves the state as it is.

    Approval needs a labelled task: an admin approves finally, a reviewer once for a
    first approval. Rejection needs a note.
    """
    approve = F.when(actor == "admin", F.lit("approved")).when(~status.isin("approved", "first_approved"), F.lit("first_approved")).otherwise(status)
    rejected = F.length(F.trim(F.coalesce(note, F.lit("")))) > 0
    return F.when((action == "approve") & labeled, approve).when((action == "reject") & rejected, F.lit("rejected")).otherwise(status)


def overturns(history: DataFrame) -> DataFrame:
    """(who, first_approved, overturned, rate) from rows of task, ts, action, who and final.

    A final rejection counts against the reviewer of the task's last first approval
    at or before it. rate is in percent, rounded to one digit.
    """
    charged = latest_before(history, "task", ["ts"], F.col("action") == "first_approved", F.col("who"), "charged")
    lost = charged.where("action = 'rejected' AND final AND charged IS NOT NULL").groupBy(F.col("charged").alias("who")).agg(F.count("*").alias("overturned"))
    approved = history.where("action = 'first_approved'").groupBy("who").agg(F.count("*").alias("first_approved"))
    joined = approved.join(lost, "who", "left").withColumn("overturned", F.coalesce("overturned", F.lit(0)).cast("long"))
    return joined.withColumn("rate", F.round(100.0 * F.col("overturned") / F.col("first_approved"), 1))
