"""Who may start an application: requests, deletions and expiries of one log, folded in order.

A request finds "already exists" if its user has an active application for the form at that moment. Which ones are
active depends on the requests before: one that was refused started nothing, one that was deleted since is no
obstacle. Told by rows in order that is a loop over each user and form. Here it is a question of intervals, so that no
user and form, however hot, goes through one task:

1. An application lives from its request to its first end (``ends``, or its delete date), or for ever. Stored
   applications and forced requests are there whatever the others do; requests that they cover are refused.
2. Of the others, the first of a user and form is accepted, and the next accepted one is the first that comes at or
   after its end, and so on: a chain of pointers, found by one ordered lookup.
3. The chain is followed by doubling: a round adds the ends of all jumps so far and doubles the jumps, so a chain of a
   million applications takes twenty rounds of joins by user, form and time, whose rows no hot pair gathers.

Requests of the same microsecond count in the order of their ids; an end counts before a request of its microsecond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators.changes import CREATE, apply_creates
from proofmark.operators.nearest import nearest
from proofmark.operators.skew import join_lookup
from proofmark.operators.stored import stored

ALWAYS, NEVER = -(1 << 62), 1 << 62  # microseconds before and after any
DAY_US = 86_400_000_000
KEY = ["user_id", "form_no"]


def _first_ends(starts: DataFrame, ends: DataFrame, slot_us: int) -> DataFrame:
    """``(application_id, at, end)``: the first end of each application at or after its start."""
    facts = ends.select("application_id", F.unix_micros("at").alias("at")).withColumn("measure", F.col("at"))
    points = starts.select("application_id", "at")
    return nearest(points, facts, ["application_id"], slot_us, backward=False).withColumnRenamed("next", "end")


def _lives(requests: DataFrame, ends: DataFrame, slot_us: int) -> DataFrame:
    """Requests with the microsecond they come at, and the one at which what they start ends."""
    timed = requests.select("*", F.unix_micros("at").alias("_at"))
    found = _first_ends(timed.select("application_id", F.col("_at").alias("at")), ends, slot_us)
    found = found.select("application_id", F.col("at").alias("_at"), F.col("end").alias("_end"))
    limit = F.unix_micros("delete_at") if "delete_at" in requests.columns else F.lit(None).cast("long")
    end = F.least("_end", limit)
    end = F.when(end.isNull(), NEVER).otherwise(F.greatest(end, F.col("_at")))  # not before the request
    return join_lookup(timed, found, ["application_id", "_at"]).withColumn("_end", end)


def _covered(rows: DataFrame, lives: DataFrame, slot_us: int) -> DataFrame:
    """``rows`` with ``_until`` (how far applications that began in earlier microseconds live) and ``_first`` (the
    least id among those of the same microsecond that live on)."""
    points = rows.select(*KEY, (F.col("_at") - 1).alias("at")).distinct()
    facts = lives.select(*KEY, F.col("_at").alias("at"), F.col("_end").alias("measure"))
    before = nearest(points, facts, KEY, slot_us, forward=False)
    before = before.select(*KEY, (F.col("at") + 1).alias("_at"), F.col("last").alias("_until"))
    same = lives.filter("_end > _at").groupBy(*KEY, "_at").agg(F.min("request_id").alias("_first"))
    return join_lookup(join_lookup(rows, before, [*KEY, "_at"]), same, [*KEY, "_at"])


def _free() -> Column:
    """Whether nothing lives at a row that ``_covered`` has seen."""
    until = F.coalesce("_until", F.lit(ALWAYS)) <= F.col("_at")
    return until & (F.col("_first").isNull() | (F.col("_first") >= F.col("request_id")))


def _chain(nodes: DataFrame, slot_us: int) -> DataFrame:
    """The accepted of ``nodes`` (key, ``_at``, ``_end``, one per key and time): the first of each key, and from each
    accepted one the first at or after its end."""
    nodes = stored(nodes, "start-nodes")
    facts = nodes.select(*KEY, F.col("_at").alias("at")).withColumn("measure", F.col("at"))
    points = nodes.filter(F.col("_end") < NEVER).select(*KEY, F.col("_end").alias("at")).distinct()
    after = nearest(points, facts, KEY, slot_us, backward=False)
    after = after.filter("next IS NOT NULL").select(*KEY, F.col("at").alias("_end"), F.col("next").alias("to"))
    jumps = stored(join_lookup(nodes, after, [*KEY, "_end"], "inner").select(*KEY, "_at", "to"), "start-jumps")
    taken = stored(nodes.groupBy(*KEY).agg(F.min("_at").alias("_at")), "start-taken")
    while not jumps.isEmpty():
        reached = join_lookup(jumps, taken, [*KEY, "_at"], "left_semi").select(*KEY, F.col("to").alias("_at"))
        taken = stored(taken.unionByName(reached).distinct(), "start-taken")
        further = jumps.select(*KEY, F.col("_at").alias("to"), F.col("to").alias("next"))
        jumps = stored(join_lookup(jumps, further, [*KEY, "to"], "inner").select(*KEY, "_at", F.col("next").alias("to")), "start-jumps")
    return join_lookup(nodes, taken, [*KEY, "_at"], "left_semi")


def fold_starts(
    requests: DataFrame,
    apps: DataFrame,
    ends: DataFrame,
    active: Sequence[str] = (v.CREATED, v.COMPLETED),
    force: str = "force",
    slot_us: int = DAY_US,
) -> tuple[DataFrame, DataFrame]:
    """``(new, existing)`` of requests ``(request_id, application_id, user_id, form_no, at, force, …)`` in order.

    ``ends`` ``(application_id, at)`` are moments at which an application stops being active: accepted deletions,
    expiries, submissions; those before its request don't count. ``delete_at``, where requests or ``apps`` have it, ends
    one too. ``apps`` were there before; only those with an ``active`` status can be in the way, and one of them is
    for a request of its id ("application exists"). Of several requests with one id the first counts, the others are
    "created twice". Requests without a user, form or time are new.
    """
    columns = requests.columns
    order = F.struct("at", "request_id")
    first = requests.groupBy("application_id").agg(F.min(order).alias("_place"))
    known = apps.select("application_id", F.lit(True).alias("_known")).distinct()
    judged = join_lookup(requests, first.join(known, "application_id", "left"), "application_id").withColumn(
        "answer", F.when(F.col("_known"), "application exists").when(order > F.col("_place"), "created twice")
    )
    judged = stored(judged.select(*columns, "answer"), "start-judged")
    lives = stored(_lives(judged.filter("answer IS NULL").drop("answer"), ends, slot_us), "start-lives")

    owned = F.col("user_id").isNotNull() & F.col("form_no").isNotNull() & F.col("_at").isNotNull()
    forced = F.coalesce(F.col(force), F.lit(False))
    standing = apps.withColumn("_at", F.lit(ALWAYS)).filter(F.col("status").isin(*active) & owned)
    stop = ends.groupBy("application_id").agg(F.min(F.unix_micros("at")).alias("end"))
    limit = F.unix_micros("delete_at") if "delete_at" in apps.columns else F.lit(None).cast("long")
    standing = join_lookup(standing, stop, "application_id").select(
        *KEY, "_at", F.coalesce(F.least("end", limit), F.lit(NEVER)).alias("_end"), F.lit(None).cast(requests.schema["request_id"].dataType).alias("request_id")
    )
    given = lives.filter(forced & owned).select(*KEY, "_at", "_end", "request_id").unionByName(standing)
    asking = stored(_covered(lives.filter(~forced & owned), given, slot_us).withColumn("_open", _free()).drop("_until", "_first"), "start-asking")

    open_ones = asking.filter("_open")
    nodes = open_ones.filter("_end > _at").groupBy(*KEY, "_at").agg(F.min(F.struct("request_id", "_end")).alias("n"))
    chain = stored(_chain(nodes.select(*KEY, "_at", "n.request_id", "n._end"), slot_us), "start-chain")
    free = _covered(open_ones, chain, slot_us).withColumn("_open", _free())
    new = free.filter("_open").select(*columns).unionByName(lives.filter(forced | ~owned).select(*columns))
    refused = asking.filter(~F.col("_open")).unionByName(free.filter(~F.col("_open")).select(*asking.columns))
    existing = refused.select(*columns, F.lit(v.ALREADY_EXISTS).alias("answer"))
    return new, existing.unionByName(judged.filter("answer IS NOT NULL"))


def apply_starts(
    changes: DataFrame, apps: DataFrame, ends: DataFrame, active: Sequence[str] = (v.CREATED, v.COMPLETED), force: str = "force"
) -> tuple[DataFrame, DataFrame]:
    """``(new applications, refused create changes with their reason)``: ``apply_creates`` for creates that may find
    an application of the same user and form, in the stored table or earlier in the log."""
    creates = changes.filter(F.col("op") == CREATE).withColumn("request_id", F.col("change_id"))
    new, existing = fold_starts(creates, apps, ends, active, force)
    state, _ = apply_creates(new.drop("request_id"), apps)
    return state, existing.drop("request_id").withColumnRenamed("answer", "reason")
