"""Selections and joins over applications, files, code lists, activities and nested submissions.

Results are flat rows, not collected lists: a hot application stays spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.functions.columns import overlaps
from proofmark.operators.nearest import nearest
from proofmark.operators.skew import join_lookup


def applications_for_form(
    apps: DataFrame, form_no: str, types: Sequence[str] | None = None, user_id=None
) -> DataFrame:
    """Applications for a form, optionally of given types and of one user."""
    out = apps.filter(F.col("form_no") == form_no)
    if types is not None:
        out = out.filter(F.col("app_type").isin(*types))
    if user_id is not None:
        out = out.filter(F.col("user_id") == user_id)
    return out


def applications_for_requests(apps: DataFrame, requests: DataFrame) -> DataFrame:
    """As above for a table of requests ``(user_id, form_no)``."""
    key = ["user_id", "form_no"]
    return join_lookup(apps, requests.select(*key).distinct(), key, "left_semi")


def application_detail(apps: DataFrame, attachments: DataFrame, files: DataFrame) -> DataFrame:
    """One row per application, attachment and file; what is missing is null, not left out.

    File content is never read: only the named columns reach the scan. The rows with files come from inner
    joins that start at the files, since adaptive execution can split a hot application or attachment only
    there and not on the right of an outer join; those without come from anti joins.
    """
    a = attachments.select(
        "application_id", F.col("id").alias("attachment_id"), "code", F.col("title").alias("attachment_title")
    )
    f = files.select(
        "attachment_id", F.col("id").alias("file_id"), F.col("name").alias("file_name"), F.col("size").alias("file_size")
    )
    with_files = f.join(a, "attachment_id").join(apps, "application_id")
    without_files = join_lookup(a, f.select("attachment_id").distinct(), "attachment_id", "left_anti").join(
        apps, "application_id"
    )
    without_attachments = join_lookup(apps, a.select("application_id").distinct(), "application_id", "left_anti")
    return with_files.unionByName(without_files, allowMissingColumns=True).unionByName(
        without_attachments, allowMissingColumns=True
    )


def attachment_files(attachments: DataFrame, files: DataFrame) -> DataFrame:
    """Number and size of the files per attachment; none counts 0."""
    f = files.groupBy("attachment_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"))
    return (
        attachments.select("application_id", F.col("id").alias("attachment_id"))
        .join(f, "attachment_id", "left")
        .fillna(0, ["files", "size"])
    )


def merged_files(stored: DataFrame) -> DataFrame:
    """One answer per file id; several files on an id become one. Deleted only when all of them are."""
    live = F.col("file_status") != "deleted"
    return stored.groupBy("id").agg(
        F.coalesce(F.sum(F.when(live, F.col("size"))), F.lit(0).cast("long")).alias("size"),
        F.count_if(live).alias("files"),
        F.when(F.bool_or(live), F.lit("ok")).otherwise(F.lit("deleted")).alias("file_status"),
    )


def files_by_ids(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Every id of a request's list answers: ok, deleted or notfound. ``requests`` has ``request_id, ids``."""
    asked = requests.select("request_id", F.posexplode("ids").alias("pos", "id"))
    return (
        join_lookup(asked, merged_files(stored), "id")
        .withColumn("file_status", F.coalesce("file_status", F.lit("notfound")))
        .fillna(0, ["size", "files"])
    )


def merge_manifest(requests: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(parts in list order, totals per request)``; the bytes themselves are not merged."""
    parts = (
        requests.select("request_id", F.posexplode("ids").alias("pos", "id"))
        .join(files.select("id", "size", "pages"), "id", "left")
    )
    totals = parts.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("parts"),
        F.count_if(F.col("size").isNull()).alias("missing"),
        F.sum("size").alias("size"),
        F.sum("pages").alias("pages"),
    )
    return parts, totals


def split_existing(
    requests: DataFrame,
    apps: DataFrame,
    active: Sequence[str] = (v.CREATED, v.COMPLETED),
    force: str = "force",
) -> tuple[DataFrame, DataFrame]:
    """``(new, existing)``: a user with an active application for the form gets "already exists", unless
    the request forces a new one."""
    open_forms = apps.filter(F.col("status").isin(*active)).select("user_id", "form_no").distinct()
    key = ["user_id", "form_no"]
    forced = F.coalesce(F.col(force), F.lit(False))
    unforced = requests.filter(~forced)
    new = requests.filter(forced).unionByName(join_lookup(unforced, open_forms, key, "left_anti"))
    existing = join_lookup(unforced, open_forms, key, "left_semi").withColumn("answer", F.lit(v.ALREADY_EXISTS))
    return new, existing


def linked_files(
    followups: DataFrame, attachments: DataFrame, files: DataFrame, show: str = "show_linked"
) -> tuple[DataFrame, DataFrame]:
    """``(follow-ups with their linked application's file count and size, the files they show)``.

    The files are listed once per linked application and not once per follow-up, so many follow-ups on
    one application do not multiply its files.
    """
    shown = F.coalesce(F.col(show), F.lit(False))
    f = (
        files.select("attachment_id", F.col("id").alias("file_id"), "size")
        .join(
            attachments.select(F.col("id").alias("attachment_id"), F.col("application_id").alias("linked_id")),
            "attachment_id",
        )
    )
    wanted = followups.filter(shown).select("linked_id").distinct()
    listed = join_lookup(f, wanted, "linked_id", "left_semi")
    totals = f.groupBy("linked_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"))
    summary = join_lookup(followups, totals, "linked_id")
    for c in ("files", "size"):
        summary = summary.withColumn(c, F.when(shown, F.coalesce(c, F.lit(0).cast("long"))).otherwise(0))
    return summary, listed


def validate_codes(df: DataFrame, codes: DataFrame, column: str = "code") -> tuple[DataFrame, DataFrame]:
    """``(rows with a listed code or none, rows with an unknown one)``."""
    listed = codes.select(F.col("code").alias(column)).distinct()
    given = F.col(column).isNotNull()
    ok = df.filter(~given).unionByName(join_lookup(df.filter(given), listed, column, "left_semi").select(*df.columns))
    bad = join_lookup(df.filter(given), listed, column, "left_anti").select(*df.columns)
    return ok, bad


def fill_titles(df: DataFrame, codes: DataFrame, lang: str = "language", column: str = "code") -> DataFrame:
    """A missing title comes from the code list in the row's language, else in the fallback language.

    The list is brought to one row per code with its titles by language, so one join serves both and adds no
    rows; a code has at most as many entries as there are languages.
    """
    by_language = F.map_from_entries(F.collect_list(F.struct("language", "title")))
    titles = (
        codes.filter("language IS NOT NULL")
        .groupBy("code", "language")
        .agg(F.min("title").alias("title"))
        .groupBy(F.col("code").alias(column))
        .agg(by_language.alias("titles"))
    )
    own, fallback = F.try_element_at("titles", F.col(lang)), F.try_element_at("titles", F.lit(v.FALLBACK_LANGUAGE))
    return join_lookup(df, titles, column).withColumn("title", F.coalesce("title", own, fallback)).drop("titles")


def activities_in_period(df: DataFrame, start: Column, end: Column | None = None, today: Column | None = None):
    """Activities that share a day with the period; its end defaults to 60 days from today."""
    if end is None:
        end = F.date_add(F.current_date() if today is None else today, v.ACTIVITY_DAYS_AHEAD)
    return df.filter(overlaps(F.col("from_date"), F.col("to_date"), start, end))


def target_groups_in_period(df: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """As above; the end defaults to 2099-12-31."""
    end = F.to_date(F.lit(v.TARGET_GROUP_END)) if end is None else end
    return df.filter(overlaps(F.col("from_date"), F.col("to_date"), start, end))


def daily_travel(activities: DataFrame) -> DataFrame:
    """Activities with a daily-travel decision, their case cut down to these decisions."""
    daily = F.filter(F.col("case.decisions"), lambda d: d["daily_travel"])
    return (
        activities.withColumn("case", F.when(F.size(daily) > 0, F.col("case").withField("decisions", daily)))
        .filter(F.col("case").isNotNull())
    )


def best_target_group(
    activities: DataFrame, groups: DataFrame, priority: Sequence[str] = tuple(v.TARGET_GROUP_TYPES)
) -> DataFrame:
    """Each activity with the first group type of ``priority`` that overlaps its period, if any.

    No activity meets every group of its person. A group of a type overlaps ``[a, b]`` exactly when the
    latest end among those that start by b reaches a. That latest end is a running maximum over the start
    dates, so one lookup per person and end date answers all types at once. A person's dates bound each
    group after the map-side combine. Among equal types the one with the latest end is named.
    """
    day = lambda c: F.unix_date(c).cast("long")
    endless = F.to_date(F.lit("9999-12-31"))
    group = F.struct(F.coalesce("to_date", endless).alias("until"), F.col("from_date").alias("from"), F.col("name"))
    names = [f"type_{i}" for i in range(len(priority))]
    facts = groups.filter(F.col("group_type").isin(*priority)).select(
        "person_id",
        day(F.col("from_date")).alias("at"),
        *[F.when(F.col("group_type") == t, group).alias(n) for t, n in zip(priority, names)],
    )
    a = activities.withColumn("end_day", day(F.coalesce("to_date", endless)))
    points = a.select("person_id", F.col("end_day").alias("at"))
    found = nearest(points, facts, ["person_id"], None, forward=False, measures=names)
    best = F.coalesce(
        *[
            F.when(
                F.col(f"last_{n}.until") >= F.col("from_date"),
                F.struct(F.lit(t).alias("group_type"), F.col(f"last_{n}.name").alias("name")),
            )
            for t, n in zip(priority, names)
        ]
    )
    own = [c for c in activities.columns if c != "target_group"]
    return a.join(found.withColumnRenamed("at", "end_day"), ["person_id", "end_day"], "left").select(
        *own, best.alias("target_group")
    )


def payment_lines(activities: DataFrame) -> DataFrame:
    """Case, decisions and payment lines as flat rows; a case without either keeps its row."""
    decisions = activities.select(
        "activity_id", F.col("case.case_id").alias("case_id"), F.explode_outer("case.decisions").alias("d")
    )
    return decisions.select(
        "activity_id",
        "case_id",
        F.col("d.decision_id").alias("decision_id"),
        F.explode_outer("d.payment_plan").alias("p"),
    ).select(
        "activity_id",
        "case_id",
        "decision_id",
        F.col("p.plan_id").alias("plan_id"),
        F.col("p.amount").alias("amount"),
        F.col("p.from_date").alias("from_date"),
        F.col("p.to_date").alias("to_date"),
        F.col("p.journal_id").alias("journal_id"),
    )


def payment_totals(activities: DataFrame) -> DataFrame:
    """Lines and amount per decision, inside the row: no grouping needed."""
    d = F.explode_outer("case.decisions").alias("d")
    amounts = F.transform(F.col("d.payment_plan"), lambda p: F.coalesce(p["amount"], F.lit(0).cast("long")))
    return activities.select("activity_id", F.col("case.case_id").alias("case_id"), d).select(
        "activity_id",
        "case_id",
        F.col("d.decision_id").alias("decision_id"),
        F.coalesce(F.size("d.payment_plan"), F.lit(0)).cast("long").alias("lines"),
        F.aggregate(F.coalesce(amounts, F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda s, x: s + x).alias(
            "amount"
        ),
    )


def prefill(df: DataFrame, properties: Sequence[str]) -> DataFrame:
    """Only the listed properties; an unknown one is an error."""
    unknown = [p for p in properties if p not in df.columns]
    if unknown:
        raise ValueError(f"unknown properties: {', '.join(unknown)}")
    return df.select(*properties)


def flatten_submissions(df: DataFrame) -> DataFrame:
    """One row per variant of each document; one variant is one physical file.

    For an inner explode Spark infers a filter that builds the documents twice more. A submission without documents has
    no variants and goes with the second one.
    """
    documents = df.select(
        "submission_id", "theme", F.posexplode_outer("documents").alias("document_no", "d")
    )
    return documents.select(
        "submission_id",
        "theme",
        "document_no",
        F.col("d.form_no").alias("form_no"),
        F.col("d.is_main").alias("is_main"),
        F.col("d.title").alias("title"),
        F.posexplode("d.variants").alias("variant_no", "x"),
    ).select("*", "x.id", "x.media_type", "x.file_name", "x.file_type").drop("x")
