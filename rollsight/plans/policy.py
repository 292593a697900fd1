"""The drift policy as a job: check, remember, and train again when live recall has dropped.

Each check appends one row to the policy's log: what it decided and why, the recalls it saw, and the
counts carried on from the row before. Firing needs the policy's lease, which one check at a time can
hold; a lease left behind by a lost driver can be taken over once it has run out.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import contract as C
from ..operators.drift import drift_decision
from ..sources import markers as K
from ..sources.tables import append_batch, read_batches

LEASE_S = 3600.0

LOG_SCHEMA = T.StructType(
    [
        T.StructField("check_no", T.LongType()),
        T.StructField("checked_at", T.TimestampNTZType()),
        T.StructField("drifted", T.BooleanType()),
        T.StructField("fired", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("fires", T.LongType()),
        T.StructField("last_fired", T.TimestampNTZType()),
        T.StructField("version", T.IntegerType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in C.FAMILY_RECALLS]
)


class Lease:
    """The right to train: held by one owner, given back at the end, taken over when it ran out."""

    def __init__(self, spark: SparkSession, path: str, now: dt.datetime, length_s: float = LEASE_S):
        self.spark, self.path, self.now, self.length_s = spark, path, now, length_s
        self.owner = uuid.uuid4().hex

    def take(self) -> bool:
        terms = json.dumps({"owner": self.owner, "until": (self.now + dt.timedelta(seconds=self.length_s)).isoformat()})
        if K.create_once(self.spark, f"{self.path}/lease", terms):
            return True
        held = K.text_of(self.spark, f"{self.path}/lease")
        if not held or dt.datetime.fromisoformat(json.loads(held)["until"]) > self.now:
            return False
        # One of those who find it run out may remove it: the mark bears the old owner's name.
        if not K.create_once(self.spark, f"{self.path}/over={json.loads(held)['owner']}"):
            return False
        K.swap_text(self.spark, f"{self.path}/lease", terms)
        return True

    def give_back(self) -> None:
        held = K.text_of(self.spark, f"{self.path}/lease")
        if held and json.loads(held)["owner"] == self.owner:
            K.remove(self.spark, f"{self.path}/lease")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per check so far."""
    if not K.numbers(spark, path, "batch_id"):
        return spark.createDataFrame([], LOG_SCHEMA)
    return read_batches(spark, path, LOG_SCHEMA).select(*LOG_SCHEMA.names)


def state(spark: SparkSession, path: str):
    """The newest row of the log; None before the first check."""
    done = K.numbers(spark, path, "batch_id")
    if not done:
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/batch_id={done[-1]}").first()


def check(
    scored: DataFrame, registry: DataFrame, path: str, train: Callable[[], dict],
    policy: C.DriftPolicy = C.DriftPolicy(), now: dt.datetime | None = None, lease_s: float = LEASE_S,
) -> dict:
    """One check: decide, call `train` if recall has dropped, log the outcome and return it.

    `train` publishes a version and returns a dict with it, as `plans.training.retrain` does. It is
    not called while another check trains, nor within the policy's interval after the last firing,
    even if that training failed. An error in training is logged and does not end the caller's loop.
    """
    spark = scored.sparkSession
    moment = (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    decision = drift_decision(scored, registry, policy, moment).first()
    before = state(spark, path)
    fires, last_fired = (before["fires"], before["last_fired"]) if before else (0, None)
    reason, fired, version = decision["reason"], False, None
    if decision["fire"]:
        lease = Lease(spark, f"{path}/_training", moment, lease_s)
        rested = last_fired is None or (moment - last_fired).total_seconds() >= policy.min_interval_s
        if not rested:
            reason += f"; trained for it {(moment - last_fired).total_seconds():.0f} s ago"
        elif not lease.take():
            reason += "; a training is under way"
        else:
            try:
                # Another check may have fired between reading the log and taking the lease.
                latest = state(spark, path)
                if (latest["check_no"] if latest else None) != (before["check_no"] if before else None) and latest["fired"]:
                    reason += "; another check has just trained for it"
                else:
                    fired, fires, last_fired = True, fires + 1, moment
                    version = train()["version"]
                    reason += f"; trained version {version}"
            except Exception as problem:
                reason += f"; training failed: {type(problem).__name__}: {problem}"[:500]
            finally:
                row = _logged(spark, path, moment, decision, fired, reason, fires, last_fired, version)
                lease.give_back()
            return row
    return _logged(spark, path, moment, decision, fired, reason, fires, last_fired, version)


def _logged(spark, path, moment, decision, fired, reason, fires, last_fired, version) -> dict:
    done = K.numbers(spark, path, "batch_id")
    number = K.claim_number(spark, f"{path}/_claims", "check", done[-1] + 1 if done else 0)
    row = {
        "check_no": number, "checked_at": moment, "drifted": bool(decision["fire"]), "fired": fired, "reason": reason,
        "fires": fires, "last_fired": last_fired, "version": version,
        **{name: decision[name] for name in C.FAMILY_RECALLS},
    }
    append_batch(spark.createDataFrame([tuple(row.values())], LOG_SCHEMA).coalesce(1), path, number, by_day=False)
    return row
