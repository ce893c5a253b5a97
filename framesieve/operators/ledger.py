"""A durable task queue as a fold over events: the current state of every task from its history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATES = ("pending", "running", "done", "failed")
LEAST_LEASE, MAX_ATTEMPTS = 30.0, 2
#: The error of a task that was taken back from a dead owner.
ORPHANED = "orphaned worker recovered"


def enqueue(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """The tasks with those of ``new`` that they lack, all or nothing.

    Both have task_id, payload_json, priority; the job fails where an id comes with another payload or priority.
    """
    both = tasks.select("task_id", "payload_json", "priority", F.lit(0).alias("__new")).unionByName(new.select("task_id", "payload_json", "priority", F.lit(1).alias("__new")))
    w = W.partitionBy("task_id")
    content = F.to_json(F.struct("payload_json", "priority"), {"ignoreNullFields": "false"})
    both = both.withColumn("__c", content).withColumn("__same", F.min("__c").over(w) == F.max("__c").over(w)).withColumn("__rank", F.row_number().over(w.orderBy("__new")))
    bad = both.where("NOT __same").select("task_id").limit(1).collect()
    if bad:
        raise ValueError(f"task {bad[0][0]} exists with other content")
    fresh = both.where("__rank = 1 AND __new = 1").select("task_id", "payload_json", "priority")
    return tasks.unionByName(fresh, allowMissingColumns=True)


def claim_order(tasks: DataFrame) -> DataFrame:
    """Pending tasks in the order in which they are claimed, with their place from 1.

    Priority descends; then the older task, then the smaller id. Only the claimable head needs one task: take it with
    ``limit``, which Spark runs as a top-n.
    """
    return tasks.where("status = 'pending'").orderBy(F.col("priority").desc(), "created_at", "task_id")


def fold(events: DataFrame) -> DataFrame:
    """(task_id, status, attempt, owner, lease_expires, updated_at, result_path, error) after all events of each task.

    Events: task_id, seq, at, kind, owner, lease_seconds, and where they have them result_path and error. A claim takes a
    pending task, or one whose lease has run out, and clears its error. Heartbeat, complete, fail and retry need a live
    lease of the same owner. A done or failed task keeps its last owner; a retry gives the task back without one until it
    has been tried ``MAX_ATTEMPTS`` times, and then fails it. Requeue returns done or failed tasks to pending without
    result and error; orphan does so for a running task whose owner, named by the event, is known to be dead. Any other
    event is refused and changes nothing: see ``refused``.
    """
    return _folded(events).drop("refused")


def refused(events: DataFrame) -> DataFrame:
    """(task_id, refused): how many events of each task were refused; repeating a completion with its result is not."""
    return _folded(events).select("task_id", "refused")


def _folded(events: DataFrame) -> DataFrame:
    for name in ("result_path", "error"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "at", "kind", "owner", "lease_seconds", "result_path", "error")))
    grouped = events.groupBy("task_id").agg(ordered.alias("history"))
    kinds = {"status": "string", "attempt": "int", "owner": "string", "lease": "double", "updated": "double", "result_path": "string", "error": "string", "refused": "long"}
    start = F.lit(None).cast("struct<" + ",".join(f"{k}:{v}" for k, v in kinds.items()) + ">")
    none = F.lit(None)

    def state(s: Column, e: Column, **changes: Column) -> Column:
        """The task after an event that is granted: without lease unless it is given one."""
        new = {**{k: s[k] for k in kinds}, "lease": none, "updated": e["at"], **changes}
        return F.struct(*[new[k].cast(v).alias(k) for k, v in kinds.items()])

    def step(s: Column, e: Column) -> Column:
        at = e["at"].cast("double")
        running, until = s["status"] == "running", at + e["lease_seconds"]
        held = running & (s["lease"] > at) & (s["owner"] == e["owner"])
        free = (s["status"] == "pending") | running & (s["lease"] <= at)
        pending = {"status": F.lit("pending"), "owner": none}
        failed = {"status": F.lit("failed"), "error": e["error"]}
        repeated = (e["kind"] == "complete") & (s["status"] == "done") & (e["result_path"].isNull() | e["result_path"].eqNullSafe(s["result_path"]))
        repeated = repeated | (e["kind"] == "fail") & (s["status"] == "failed") & e["error"].eqNullSafe(s["error"])
        new = state(s, e, attempt=F.lit(0), status=F.lit("pending"), owner=none, result_path=none, error=none, refused=F.lit(0))
        return (
            F.when(s.isNull(), F.when(e["kind"] == "enqueue", new))
            .when((e["kind"] == "claim") & free, state(s, e, status=F.lit("running"), attempt=s["attempt"] + 1, owner=e["owner"], lease=until, error=none))
            .when((e["kind"] == "heartbeat") & held, state(s, e, lease=until))
            .when((e["kind"] == "complete") & held, state(s, e, status=F.lit("done"), result_path=e["result_path"], error=none))
            .when((e["kind"] == "fail") & held, state(s, e, **failed))
            .when((e["kind"] == "retry") & held & (s["attempt"] < MAX_ATTEMPTS), state(s, e, **pending, error=e["error"]))
            .when((e["kind"] == "retry") & held, state(s, e, **failed))
            .when((e["kind"] == "requeue") & s["status"].isin("done", "failed"), state(s, e, **pending, result_path=none, error=none))
            .when((e["kind"] == "orphan") & running & (s["owner"] == e["owner"]), state(s, e, **pending, error=F.lit(ORPHANED)))
            .when(repeated | (e["kind"] == "enqueue"), s)
            .otherwise(s.withField("refused", s["refused"] + 1))
        )

    folded = grouped.withColumn("s", F.aggregate("history", start, step))
    return folded.select("task_id", "s.status", "s.attempt", "s.owner", F.col("s.lease").alias("lease_expires"), F.col("s.updated").alias("updated_at"), "s.result_path", "s.error", "s.refused")


def recover_expired(state: DataFrame, now: float) -> DataFrame:
    """Running tasks whose lease has run out become pending, without owner and lease; ``updated_at``, if there, is ``now``."""
    late = F.coalesce((F.col("status") == "running") & (F.col("lease_expires") <= now), F.lit(False))
    changes = {"owner": F.lit(None).cast("string"), "status": F.lit("pending"), "lease_expires": F.lit(None).cast("double"), "updated_at": F.lit(float(now))}
    marked = state.withColumn("__late", late)
    return marked.withColumns({c: F.when(F.col("__late"), v).otherwise(F.col(c)) for c, v in changes.items() if c in state.columns}).drop("__late")


def listed(tasks: DataFrame, status: str | None = None) -> DataFrame:
    """The tasks, or those of one status, by creation and id; ValueError for a status there is not."""
    if status is not None and status not in STATES:
        raise ValueError(f"unknown status {status!r}")
    return (tasks if status is None else tasks.where(F.col("status") == status)).orderBy("created_at", "task_id")


def get(tasks: DataFrame, task_id: str) -> dict | None:
    """One task, or None."""
    found = tasks.where(F.col("task_id") == task_id).first()
    return None if found is None else found.asDict()


def unfinished(expected: DataFrame, written: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks whose valid output is missing: what a resumed stage computes."""
    return expected.join(written.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")
