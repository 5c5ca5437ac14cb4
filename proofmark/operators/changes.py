"""Applying logged changes to applications, attachments and files.

A change log is a table; one job folds it into the state. Within one application the changes count in
the order of ``(at, change_id)``. No row order is replayed: each field's last accepted change is a
map-side combined maximum, so an application with a third of all changes is as cheap as any other.
Every function that can refuse a change returns ``(state, rejected)``, rejected rows with a reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.functions.columns import days_after
from proofmark.operators.skew import join_lookup

CREATE, UPDATE, COMPLETE, STEP = "create", "update", "completed", "step"
DELETE, EXTERNAL_DELETE = "delete", "external_delete"
ADD, PATCH, REMOVE = "add", "patch", "remove"

# An update never touches these.
KEPT = ("application_id", "id", "user_id", "form_no", "created_at", "status", "archive_status", "step")


def order() -> Column:
    return F.struct("at", "change_id")


def create_changes(requests: DataFrame, kind: str) -> DataFrame:
    """Create changes from a table of requests ``(change_id, application_id, at, actor, …)``.

    The ways to create an application differ in their types, in who may delete it later (the actor of an
    external one), and in the form, which loose mail lacks. All start at step 0, and are kept for
    ``retention_days`` where the request gives them.
    """
    app_type, display_type, by_agency = v.CREATE_KINDS[kind]
    out = requests.withColumns(
        {
            "op": F.lit(CREATE),
            "app_type": F.lit(app_type),
            "display_type": F.lit(display_type),
            "agency_created": F.lit(by_agency),
            "step": F.lit(0).cast("long"),
            "app_source": F.col("actor") if kind in ("external_followup", "task") else F.lit(None).cast("string"),
        }
    )
    if kind == "loose_mail":
        out = out.withColumn("form_no", F.lit(None).cast("string"))
    if "retention_days" in requests.columns:
        out = out.withColumn("delete_at", days_after(F.col("at"), F.col("retention_days")))
    return out


def apply_creates(changes: DataFrame, apps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New applications from create changes; the first create of an id wins.

    ``create_changes`` makes them from requests of each kind.
    """
    creates = changes.filter(F.col("op") == CREATE)
    known = apps.select("application_id", F.lit(True).alias("known")).distinct()
    first = creates.groupBy("application_id").agg(F.min(order()).alias("first"))
    judged = (
        join_lookup(creates, first.join(known, "application_id", "left"), "application_id", "inner")
        .withColumn(
            "reason",
            F.when(F.col("known"), "application exists").when(order() > F.col("first"), "created twice"),
        )
        .drop("known", "first")
    )
    state = (
        judged.filter("reason IS NULL")
        .withColumn("created_at", F.col("at"))
        .withColumn("status", F.lit(v.CREATED))
        .withColumn("archive_status", F.lit(v.ARCHIVE_NOT_SET))
        .drop("op", "reason", "change_id", "at")
    )
    return state, judged.filter("reason IS NOT NULL")


def judged_changes(changes: DataFrame, apps: DataFrame, gone: Sequence[str] = ()) -> DataFrame:
    """Each change with its ``reason`` to be refused, or null.

    An application whose status is one of ``gone`` was deleted before the log begins. What is known per application (its creator, its first accepted delete) is one lookup row, so the log is
    joined once.
    """
    owner = F.col("app_source") if "app_source" in apps.columns else F.lit(None).cast("string")
    was = F.col("status").isin(*gone) if gone else F.lit(False)
    known = apps.select("application_id", owner.alias("owner"), F.lit(True).alias("known"), was.alias("was"))
    log = changes.filter(F.col("op") != CREATE)
    foreign = (F.col("op") == EXTERNAL_DELETE) & ~F.col("actor").eqNullSafe(F.col("owner"))
    deletes = (
        log.filter(F.col("op").isin(DELETE, EXTERNAL_DELETE))
        .select("application_id", "op", "actor", order().alias("place"))
        .join(known, "application_id")
        .filter(~foreign)
        .groupBy("application_id")
        .agg(F.min("place").alias("deleted"))
    )
    listed = F.col("attachments") > 0 if "attachments" in changes.columns else F.lit(False)
    lookup = known.join(deletes, "application_id", "left")
    return (
        join_lookup(log, lookup, "application_id")
        .withColumn(
            "reason",
            F.when(F.col("known").isNull(), "unknown application")
            .when((F.col("op") == UPDATE) & listed, "attachment list must be empty")
            .when(foreign, "deleted by its creator only")
            .when(F.col("was") | (order() > F.col("deleted")), "deleted before"),
        )
        .drop("known", "owner", "deleted", "was")
    )


def apply_changes(
    apps: DataFrame, changes: DataFrame, fields: Sequence[str] | None = None, gone: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Updates, completions, step marks and deletes in time order.

    An update overwrites every field except user and form number and makes the status Opprettet; a
    completion does the same and makes it Utfylt; a step mark sets the step only; a delete keeps the row as
    SlettetAvBruker.
    """
    judged = judged_changes(changes, apps, gone)
    return fold_judged(apps, judged, fields), judged.filter("reason IS NOT NULL")


def fold_judged(apps: DataFrame, judged: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """``apps`` after the accepted ones of ``judged_changes``."""
    changes = judged.drop("reason")
    if fields is None:
        fields = [c for c in apps.columns if c in changes.columns and c not in KEPT]
    ok = judged.filter("reason IS NULL")
    op = F.col("op")
    writes, marks, deletes = op.isin(UPDATE, COMPLETE), op == STEP, op.isin(DELETE, EXTERNAL_DELETE)
    payload = F.struct(*[F.col(c).alias(c) for c in fields], op.alias("written_by"), F.col("at").alias("written_at"))
    step = F.col("step") if "step" in changes.columns else F.lit(None).cast("long")
    folded = ok.groupBy("application_id").agg(
        F.max_by(F.when(writes, payload), F.when(writes, order())).alias("w"),
        F.max_by(F.when(marks, step), F.when(marks, order())).alias("new_step"),
        F.max(F.when(marks, F.lit(True))).alias("marked"),
        F.max("at").alias("last_change"),
        F.max(F.when(deletes, F.lit(True))).alias("deleted"),
    )
    written = F.col("w").isNotNull()
    state = apps.join(folded, "application_id", "left")
    for c in fields:
        state = state.withColumn(c, F.when(written, F.col(f"w.{c}")).otherwise(F.col(c)))
    state = state.withColumn(
        "status",
        F.when(F.col("deleted"), v.DELETED_BY_USER)
        .when(F.col("w.written_by") == COMPLETE, v.COMPLETED)
        .when(F.col("w.written_by") == UPDATE, v.CREATED)
        .otherwise(F.col("status")),
    )
    if "step" in apps.columns:
        state = state.withColumn("step", F.when(F.col("marked"), F.col("new_step")).otherwise(F.col("step")))
    if "changed_at" in apps.columns:
        state = state.withColumn("changed_at", F.coalesce("last_change", "changed_at"))
    return state.drop("w", "new_step", "marked", "last_change", "deleted")


def apply_updates(apps: DataFrame, changes: DataFrame, fields: Sequence[str] | None = None):
    return apply_changes(apps, changes.filter(F.col("op") == UPDATE), fields)


def apply_completed(apps: DataFrame, changes: DataFrame, fields: Sequence[str] | None = None):
    return apply_changes(apps, changes.filter(F.col("op") == COMPLETE), fields)


def apply_step(apps: DataFrame, changes: DataFrame):
    return apply_changes(apps, changes.filter(F.col("op") == STEP), [])


def replace_attachments(attachments: DataFrame, completed: DataFrame, sent: DataFrame) -> DataFrame:
    """Attachment rows after completions: an application's last completion brings its own rows.

    ``completed`` has ``application_id, change_id, at``, ``sent`` the attachment rows with their ``change_id``.
    """
    last = completed.groupBy("application_id").agg(F.max_by("change_id", order()).alias("change_id"))
    kept = attachments.join(last.select("application_id"), "application_id", "left_anti")
    brought = sent.join(last, ["application_id", "change_id"], "left_semi").drop("change_id")
    return kept.unionByName(brought, allowMissingColumns=True)


def judged_attachment_changes(
    attachments: DataFrame, changes: DataFrame, other: str = v.OTHER_ATTACHMENT
) -> DataFrame:
    """Users add and delete attachments of the "other" code only, and patch existing ones."""
    current = attachments.select(F.col("id"), F.col("code").alias("current_code"))
    op = F.col("op")
    return (
        join_lookup(changes, current, "id")
        .withColumn(
            "reason",
            F.when((op == ADD) & ~F.col("code").eqNullSafe(F.lit(other)), "only other attachments can be added")
            .when((op != ADD) & F.col("current_code").isNull(), "unknown attachment")
            .when((op == REMOVE) & (F.col("current_code") != other), "only other attachments can be deleted"),
        )
        .drop("current_code")
    )


def apply_attachment_patch(
    attachments: DataFrame, changes: DataFrame, other: str = v.OTHER_ATTACHMENT
) -> tuple[DataFrame, DataFrame]:
    """``(state, rejected)``. A patch sets status and comment on any attachment, the title on "other" ones
    only; a field left null in a patch stays as it is."""
    judged = judged_attachment_changes(attachments, changes, other)
    ok = judged.filter("reason IS NULL")
    patch = F.col("op") == PATCH

    def last(c):
        given = patch & F.col(c).isNotNull()
        return F.max_by(F.when(given, F.col(c)), F.when(given, order())).alias(f"new_{c}")

    folded = ok.filter(F.col("op") != ADD).groupBy("id").agg(
        last("title"), last("upload_status"), last("comment"),
        F.max(F.when(F.col("op") == REMOVE, F.lit(True))).alias("removed"),
    )
    state = (
        attachments.join(folded, "id", "left")
        .withColumn("title", F.when(F.col("code") == other, F.coalesce("new_title", "title")).otherwise(F.col("title")))
        .withColumn("upload_status", F.coalesce("new_upload_status", "upload_status"))
        .withColumn("comment", F.coalesce("new_comment", "comment"))
        .filter(F.col("removed").isNull())
        .select(*attachments.columns)
    )
    added = ok.filter(F.col("op") == ADD).select(*[c for c in attachments.columns if c in changes.columns])
    return state.unionByName(added, allowMissingColumns=True), judged.filter("reason IS NOT NULL")


def apply_files(
    files: DataFrame, attachments: DataFrame, saved: DataFrame, deleted: DataFrame, status: str = v.UPLOADED
) -> tuple[DataFrame, DataFrame]:
    """``(files, attachments)`` after saves and deletes; an attachment that got a file becomes uploaded."""
    away = deleted.select("id").distinct()
    now = join_lookup(files.unionByName(saved.select(*files.columns)), away, "id", "left_anti")
    got = (
        join_lookup(saved, away, "id", "left_anti")
        .select(F.col("attachment_id").alias("id"), F.lit(True).alias("got"))
        .distinct()
    )
    state = (
        attachments.join(got, "id", "left")
        .withColumn("upload_status", F.when(F.col("got"), F.lit(status)).otherwise(F.col("upload_status")))
        .drop("got")
    )
    return now, state


def cascade_delete(
    ids: DataFrame,
    apps: DataFrame,
    attachments: DataFrame,
    files: DataFrame,
    notifications: DataFrame | None = None,
    status: str = v.DELETED_BY_USER,
) -> dict[str, DataFrame]:
    """Takes applications away with their attachments, files and notifications; the application row stays
    with its deleted status."""
    gone = ids.select("application_id").distinct()
    doomed = join_lookup(attachments, gone, "application_id", "left_semi").select(F.col("id").alias("attachment_id")).distinct()
    out = {
        "applications": apps.join(gone.withColumn("gone", F.lit(True)), "application_id", "left")
        .withColumn("status", F.when(F.col("gone"), F.lit(status)).otherwise(F.col("status")))
        .drop("gone"),
        "attachments": join_lookup(attachments, gone, "application_id", "left_anti"),
        "files": join_lookup(files, doomed, "attachment_id", "left_anti"),
    }
    if notifications is not None:
        ids_of = gone.select(F.col("application_id").alias("submission_id"))
        out["notifications"] = join_lookup(notifications, ids_of, "submission_id", "left_anti")
    return out


def expire(
    apps: DataFrame, as_of: Column, before_submission: Sequence[str] = (v.CREATED, v.COMPLETED)
) -> tuple[DataFrame, DataFrame]:
    """``(state, ids that expired)``: rows past their delete date that were never submitted."""
    due = F.coalesce((F.col("delete_at") <= as_of) & F.col("status").isin(*before_submission), F.lit(False))
    state = apps.withColumn("status", F.when(due, v.DELETED_BY_SCHEDULE).otherwise(F.col("status")))
    return state, apps.filter(due).select("application_id")


def expire_cascade(
    apps: DataFrame, attachments: DataFrame, files: DataFrame, as_of: Column, notifications: DataFrame | None = None,
    before_submission: Sequence[str] = (v.CREATED, v.COMPLETED),
) -> dict[str, DataFrame]:
    """The nightly deletion whole: expired applications keep a row, what belongs to them goes."""
    gone = expire(apps, as_of, before_submission)[1]
    return cascade_delete(gone, apps, attachments, files, notifications, v.DELETED_BY_SCHEDULE)


def receipt_list(mapping: Mapping[str, str] = v.RECEIPT_LISTS) -> Column:
    """The receipt list an attachment belongs to, or null."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    name = F.try_element_at(pairs, F.col("upload_status"))
    return F.when((name == "to_follow") & ~F.col("required"), None).otherwise(name)


def receipt_lines(attachments: DataFrame, mapping: Mapping[str, str] = v.RECEIPT_LISTS) -> DataFrame:
    """Attachments with the receipt list they appear in, as rows; the main document is not among them."""
    return attachments.filter(~F.col("is_main")).withColumn("list", receipt_list(mapping)).filter("list IS NOT NULL")


def receipts(apps: DataFrame, attachments: DataFrame, mapping: Mapping[str, str] = v.RECEIPT_LISTS) -> DataFrame:
    """One receipt per submitted application: received time, follow-up deadline, length of each list."""
    names = list(dict.fromkeys(mapping.values()))
    counts = (
        receipt_lines(attachments, mapping)
        .groupBy("application_id")
        .agg(*[F.count_if(F.col("list") == n).alias(n) for n in names])
    )
    submitted = apps.filter(F.col("submitted_at").isNotNull())
    return (
        submitted.select(
            "application_id",
            F.col("submitted_at").alias("received_at"),
            days_after(F.col("submitted_at"), F.col("followup_days")).alias("followup_until"),
        )
        .join(counts, "application_id", "left")
        .fillna(0, names)
    )


def archive_status(
    apps: DataFrame, feedback: DataFrame, success: str, submitted: Sequence[str] = (v.SUBMITTED,)
) -> DataFrame:
    """Archive status from the last feedback of a submitted application; others are not set.

    ``success`` is the pattern of a good message.
    """
    last = feedback.groupBy(F.col("key").alias("application_id")).agg(
        F.max_by("message", F.struct("ts", "message")).alias("message")
    )
    return (
        apps.join(last, "application_id", "left")
        .withColumn(
            "archive_status",
            F.when(~F.col("status").isin(*submitted) | F.col("message").isNull(), v.ARCHIVE_NOT_SET)
            .when(F.col("message").rlike(success), v.ARCHIVED)
            .otherwise(v.ARCHIVE_FAILED),
        )
        .drop("message")
    )


def lifecycle_violations(events: DataFrame, stages: Sequence[str] = tuple(v.LIFECYCLE)) -> DataFrame:
    """Keys whose events leave the stage order, or lack a stage before the last one they reached.

    A sequence goes down somewhere exactly when some later stage begins before an earlier one ends, so
    first and last times per stage are enough: one combined aggregate, no window over a hot key. Events at
    the same time count as in order.
    """
    t = F.col("event_type")
    firsts = [F.min(F.when(t == s, F.col("ts"))).alias(f"first_{i}") for i, s in enumerate(stages)]
    lasts = [F.max(F.when(t == s, F.col("ts"))).alias(f"last_{i}") for i, s in enumerate(stages)]
    return broken_order(events.filter(t.isin(*stages)).groupBy("key").agg(*firsts, *lasts), stages)


def broken_order(per_key: DataFrame, stages: Sequence[str]) -> DataFrame:
    """``lifecycle_violations`` of rows ``(key, first_<i>, last_<i>, …)``, the times of each stage."""
    n = range(len(stages))
    down = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"first_{j}") < F.col(f"last_{i}"), F.lit(f"{stages[j]} before {stages[i]}"))
                for j in n
                for i in range(j)
            ]
        )
    )
    reached = F.greatest(*[F.when(F.col(f"first_{i}").isNotNull(), i) for i in n])
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"first_{i}").isNull() & (F.lit(i) < reached), F.lit(stages[i])) for i in n])
    )
    return (
        per_key.select("key", down.alias("out_of_order"), missing.alias("missing"))
        .filter((F.size("out_of_order") > 0) | (F.size("missing") > 0))
    )
