"""Workload tables: generated applications with forms and attachments, and nested submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark import values as v
from proofmark.functions.columns import stable_uuid


def load_cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(v.LOAD_CASES, schemas.LOAD_CASES)


def draw(seed: int, bound: Column, *cols: Column | str) -> Column:
    """A number in ``[0, bound)`` from the columns and the seed; a recomputed row draws the same."""
    text = F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols], F.lit(seed))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), bound)


def pick_form(df: DataFrame, catalogue: DataFrame, seed: int, key: str = "application_id") -> DataFrame:
    """Gives each row a form; ``catalogue`` has ``position`` (0, 1, …) next to its own columns.

    The catalogue's size is a scalar subquery and the pick an equi join on the position, which Spark
    broadcasts when the catalogue measures small enough.
    """
    size = catalogue.select(F.count(F.lit(1))).scalar()
    return df.withColumn("position", draw(seed, size, key)).join(
        catalogue.withColumn("position", F.col("position").cast("long")), "position"
    ).drop("position")


def take_first(catalogue: DataFrame, k: int) -> DataFrame:
    """The first k entries in catalogue order."""
    return catalogue.filter(F.col("position") < k)


def take_first_per(df: DataFrame, by: list[str], order: list[Column | str], k: int) -> DataFrame:
    """The first k rows per group. The rank filter is pushed below the shuffle as a group limit, so a
    task sends at most k rows per group on."""
    return (
        df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        .filter(F.col("rank") <= k)
    )


def with_attachments(applications: DataFrame, catalogue: DataFrame, k: int, size: int) -> DataFrame:
    """Each application with its first k catalogue attachments and one file of ``size`` bytes each."""
    positions = F.array(*[F.lit(i).cast("long") for i in range(k)]).cast("array<bigint>")
    return (
        applications.withColumn("position", F.explode(positions))
        .join(take_first(catalogue.withColumn("position", F.col("position").cast("long")), k), "position")
        .withColumn("file_id", stable_uuid("application_id", "position"))
        .withColumn("size", F.lit(size).cast("long"))
    )


def generate_workload(
    spark: SparkSession,
    n: int,
    k: int,
    size: int,
    seed: int,
    forms: DataFrame,
    attachments: DataFrame,
) -> DataFrame:
    """n applications, each with a drawn form, k attachments and a file per attachment."""
    ids = spark.range(n).select(stable_uuid(F.col("id"), F.lit(seed)).alias("application_id"))
    return with_attachments(pick_form(ids, forms, seed), attachments, k, size)


def _variant(id: Column, media: str, name: Column, kind: str) -> Column:
    return F.struct(
        id.cast("string").alias("id"),
        F.lit(media).alias("media_type"),
        name.alias("file_name"),
        F.lit(kind).alias("file_type"),
    )


def _document(form_no: Column, is_main: Column, title: Column, *variants: Column) -> Column:
    return F.struct(
        form_no.alias("form_no"),
        is_main.alias("is_main"),
        title.alias("title"),
        F.array(*variants).alias("variants"),
    )


def submission_defaults(df: DataFrame) -> DataFrame:
    """A submission from what is given, defaults for the rest; never a follow-up."""

    def given(name, default):
        return (F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)).alias(name)

    empty = F.array().cast(
        "array<struct<form_no:string,is_main:boolean,title:string,"
        "variants:array<struct<id:string,media_type:string,file_name:string,file_type:string>>>>"
    )
    documents = F.coalesce(F.col("documents"), empty) if "documents" in df.columns else empty
    person = F.col("person_id") if "person_id" in df.columns else F.lit(None).cast("string")
    return df.select(
        given("submission_id", v.DEFAULT_SUBMISSION_ID),
        F.lit(False).alias("is_followup"),
        person.alias("person_id"),
        given("theme", v.DEFAULT_THEME),
        documents.alias("documents"),
    )


def submission_from_files(df: DataFrame, form_no: str, ids: str = "file_ids") -> DataFrame:
    """A submission from file ids: the first is the main document, the rest are not."""
    documents = F.transform(
        F.col(ids),
        lambda x, i: _document(
            F.lit(form_no),
            i == 0,
            F.lit(v.FILE_LIST_TITLE),
            _variant(x, v.PDF, F.lit(v.FILE_LIST_FILE_NAME), v.PDF_FILE_TYPE),
        ),
    )
    return submission_defaults(df.withColumn("theme", F.lit(v.FILE_LIST_THEME)).withColumn("documents", documents))


def title_for(df: DataFrame, titles: DataFrame, default: str = v.DEFAULT_TITLE) -> DataFrame:
    """Title by the row's own form number, else the default."""
    known = titles.select("form_no", F.col("title").alias("known_title"))
    return (
        df.join(known, "form_no", "left")
        .withColumn("title", F.coalesce("known_title", F.lit(default)))
        .drop("known_title")
    )


def submission_from_form(df: DataFrame, n: str = "attachments") -> DataFrame:
    """A submission from form number, title, theme and a number of attachments.

    The main document comes as PDF and JSON, then the receipt, then the attachments in order.
    """
    form = F.col("form_no")
    seed = F.col("submission_id")
    pdf = F.concat(form, F.lit(".pdf"))
    main = _document(
        form,
        F.lit(True),
        F.col("title"),
        _variant(stable_uuid(seed, F.lit("main"), F.lit("pdf")), v.PDF, pdf, v.PDF_FILE_TYPE),
        _variant(
            stable_uuid(seed, F.lit("main"), F.lit("json")),
            v.JSON,
            F.concat(form, F.lit(".json")),
            v.JSON_FILE_TYPE,
        ),
    )
    receipt = _document(
        F.lit(v.RECEIPT_CODE),
        F.lit(False),
        F.lit(v.RECEIPT_TITLE),
        _variant(stable_uuid(seed, F.lit("receipt")), v.PDF, pdf, v.PDF_FILE_TYPE),
    )
    numbers = F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    extra = F.transform(
        numbers,
        lambda i: _document(
            F.lit(v.ATTACHMENT_CODE),
            F.lit(False),
            F.concat(F.lit(v.ATTACHMENT_TITLE), i.cast("string")),
            _variant(
                stable_uuid(seed, F.lit("attachment"), i),
                v.PDF,
                F.lit(f"{v.ATTACHMENT_CODE}.pdf"),
                v.PDF_FILE_TYPE,
            ),
        ),
    )
    return submission_defaults(df.withColumn("documents", F.concat(F.array(main, receipt), extra)))


def documents_from_ids(df: DataFrame, form_no: str, ids: str = "file_ids", keep_last: bool = True) -> DataFrame:
    """Main document from the first id, attachments from the rest.

    ``keep_last=False`` leaves out the last id of a longer list, as the older behaviour did.
    """
    count = F.size(ids)
    rest = F.when(count > 1, F.slice(ids, 2, F.greatest(count - (1 if keep_last else 2), F.lit(0)))).otherwise(
        F.slice(ids, 1, 0)
    )
    main = _document(
        F.lit(form_no),
        F.lit(True),
        F.lit(v.DEFAULT_TITLE),
        _variant(F.get(F.col(ids), 0), v.PDF, F.lit(v.MAIN_FILE_NAME), v.PDF_FILE_TYPE),
    )
    others = F.transform(
        rest,
        lambda x: _document(
            F.lit(v.ATTACHMENT_CODE),
            F.lit(False),
            F.lit(v.DEFAULT_ATTACHMENT_TITLE),
            _variant(x, v.PDF, F.lit(v.ATTACHMENT_FILE_NAME), v.PDF_FILE_TYPE),
        ),
    )
    mains = F.when(count > 0, F.array(main)).otherwise(F.slice(F.array(main), 1, 0))
    return df.withColumn("documents", F.concat(mains, others))


def followup_requests(df: DataFrame, default_form_no: str, pairs: str = "attachments") -> DataFrame:
    """Follow-up requests with defaults; ``pairs`` is an array of (code, title) structs."""

    def given(name, default):
        return (F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)).alias(name)

    code, title = v.FOLLOWUP_ATTACHMENT
    one = F.array(F.struct(F.lit(code).alias("code"), F.lit(title).alias("title")))
    asked = one
    if pairs in df.columns:
        listed = F.transform(
            F.col(pairs), lambda p: F.struct(p["code"].alias("code"), p["title"].alias("title"))
        )
        asked = F.coalesce(listed, one)
    keep = [c for c in ("application_id", "user_id") if c in df.columns]
    return df.select(
        *keep,
        given("form_no", default_form_no),
        given("language", v.FOLLOWUP_LANGUAGE),
        given("theme", v.FOLLOWUP_THEME),
        given("title", v.FOLLOWUP_TITLE),
        asked.alias("attachments"),
    )
