"""Workload tables over the driver's tables: orders draw forms, document lines become submissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import lookups as J
from proofmark.operators import workload as G
from proofmark.plans.registry import query, table


def uuid_sql(*parts: str) -> str:
    """The SQL of ``stable_uuid``."""
    text = " || '|' || ".join(
        f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts
    )
    h = f"sha256({text})"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def parts(spark, sf):
    """``part`` as a form catalogue; its dense key is the catalogue position."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("position"),
        F.col("p_partkey").cast("string").alias("form_no"),
        F.col("p_brand").alias("theme"),
        F.col("p_name").alias("title"),
    )


def nations(spark, sf):
    """``nation`` as an attachment catalogue in key order."""
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("position"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
        F.col("n_name").alias("attachment_title"),
    )


PICKED_SQL = """
SELECT o_orderkey AS application_id, CAST(p_partkey AS VARCHAR) AS form_no, p_brand AS theme, p_name AS title
FROM orders JOIN part
  ON p_partkey = ('0x' || substr(md5(o_orderkey || ':7'), 1, 8))::BIGINT % (SELECT count(*) FROM part)
"""


def picked(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("application_id"))
    return G.pick_form(ids, parts(spark, sf), 7)


@query(PICKED_SQL)
def pick_form(spark, sf):
    """Each order draws a form."""
    return picked(spark, sf)


@query(
    f"""SELECT p.*, 'N' || n_nationkey AS code, n_name AS attachment_title,
               {uuid_sql("application_id", "n_nationkey")} AS file_id, CAST(2000000 AS BIGINT) AS size
        FROM ({PICKED_SQL}) p, nation WHERE n_nationkey < 3"""
)
def generate_workload(spark, sf):
    """Each order with its form, the first three catalogue attachments and a file for each."""
    return G.with_attachments(picked(spark, sf), nations(spark, sf), 3, 2_000_000).drop("position")


@query(
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS rank
         FROM lineitem) WHERE rank <= 2"""
)
def take_first(spark, sf):
    """The first two lines of each order."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return G.take_first_per(lines, ["l_orderkey"], order, 2).select("l_orderkey", "l_linenumber", "l_partkey", "rank")


@query(
    f"""SELECT event_id, {uuid_sql("event_id", "event_type")} AS message_id FROM events"""
)
def stable_uuid(spark, sf):
    """The same event gets the same id at every run."""
    from proofmark.functions.columns import stable_uuid as uuid

    return table(spark, sf, "events").select("event_id", uuid("event_id", "event_type").alias("message_id"))


def line_ids(spark, sf):
    """A document's text lines as the file ids of a submission."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("submission_id"),
        F.col("lang").alias("theme"),
        F.split("text", "\n").alias("file_ids"),
    )


LINES_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS submission_id, lang, unnest(string_split(text, chr(10))) AS id,
       CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS n,
       CAST(len(string_split(text, chr(10))) AS INTEGER) AS total
FROM documents
"""


@query(
    f"""SELECT submission_id, '{v.FILE_LIST_THEME}' AS theme, n AS document_no, 'F1' AS form_no, n = 0 AS is_main,
               '{v.FILE_LIST_TITLE}' AS title, 0 AS variant_no, id, '{v.PDF}' AS media_type,
               '{v.FILE_LIST_FILE_NAME}' AS file_name, '{v.PDF_FILE_TYPE}' AS file_type
        FROM ({LINES_SQL})"""
)
def submission_from_files(spark, sf):
    """First line = main document, the rest not; flattened back to files."""
    return J.flatten_submissions(G.submission_from_files(line_ids(spark, sf), "F1"))


def documents_from_ids_sql(keep_last: bool) -> str:
    left_out = "" if keep_last else " WHERE n = 0 OR n < total - 1"
    return f"""
SELECT submission_id, lang AS theme, n AS document_no, CASE WHEN n = 0 THEN 'F2' ELSE '{v.ATTACHMENT_CODE}' END AS form_no,
       n = 0 AS is_main,
       CASE WHEN n = 0 THEN '{v.DEFAULT_TITLE}' ELSE '{v.DEFAULT_ATTACHMENT_TITLE}' END AS title,
       0 AS variant_no, id, '{v.PDF}' AS media_type,
       CASE WHEN n = 0 THEN '{v.MAIN_FILE_NAME}' ELSE '{v.ATTACHMENT_FILE_NAME}' END AS file_name,
       '{v.PDF_FILE_TYPE}' AS file_type
FROM ({LINES_SQL}){left_out}"""


@query(documents_from_ids_sql(True))
def documents_from_ids(spark, sf):
    return J.flatten_submissions(G.documents_from_ids(line_ids(spark, sf), "F2"))


@query(documents_from_ids_sql(False))
def documents_from_ids_short(spark, sf):
    """The older behaviour that leaves out the last id."""
    return J.flatten_submissions(G.documents_from_ids(line_ids(spark, sf), "F2", keep_last=False))


def named_orders(spark, sf):
    """Orders with their priority as form number; titles are known for three of the five forms."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("o_orderpriority").alias("form_no"),
        F.col("o_orderstatus").alias("theme"),
        F.ascii(F.substring("o_orderpriority", 1, 1)).alias("code"),
    ).withColumn("attachments", F.col("code") - F.lit(49)).drop("code")
    titles = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority") >= "3")
        .select(F.col("o_orderpriority").alias("form_no"))
        .distinct()
        .withColumn("title", F.concat(F.lit("Form "), F.col("form_no")))
    )
    return G.title_for(orders, titles)


NAMED_ORDERS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS submission_id, o_orderpriority AS form_no, o_orderstatus AS theme,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS attachments,
       CASE WHEN o_orderpriority >= '3' THEN 'Form ' || o_orderpriority ELSE '{v.DEFAULT_TITLE}' END AS title
FROM orders
"""


@query(NAMED_ORDERS_SQL)
def title_for(spark, sf):
    return named_orders(spark, sf)


@query(
    f"""WITH o AS ({NAMED_ORDERS_SQL})
    SELECT submission_id, theme, 0 AS document_no, form_no, true AS is_main, title, 0 AS variant_no,
           {uuid_sql("submission_id", "'main'", "'pdf'")} AS id, '{v.PDF}' AS media_type,
           form_no || '.pdf' AS file_name, '{v.PDF_FILE_TYPE}' AS file_type FROM o
    UNION ALL SELECT submission_id, theme, 0, form_no, true, title, 1, {uuid_sql("submission_id", "'main'", "'json'")},
           '{v.JSON}', form_no || '.json', '{v.JSON_FILE_TYPE}' FROM o
    UNION ALL SELECT submission_id, theme, 1, '{v.RECEIPT_CODE}', false, '{v.RECEIPT_TITLE}', 0,
           {uuid_sql("submission_id", "'receipt'")}, '{v.PDF}', form_no || '.pdf', '{v.PDF_FILE_TYPE}' FROM o
    UNION ALL SELECT submission_id, theme, i + 2, '{v.ATTACHMENT_CODE}', false, '{v.ATTACHMENT_TITLE}' || i, 0,
           {uuid_sql("submission_id", "'attachment'", "i")}, '{v.PDF}', '{v.ATTACHMENT_CODE}.pdf', '{v.PDF_FILE_TYPE}'
    FROM (SELECT *, CAST(unnest(range(attachments)) AS INTEGER) AS i FROM o)"""
)
def submission_from_form(spark, sf):
    """Main document as PDF and JSON, receipt, then the attachments."""
    return J.flatten_submissions(G.submission_from_form(named_orders(spark, sf)))


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS submission_id, false AS is_followup,
              CASE WHEN lang <> 'en' THEN lang ELSE '{v.DEFAULT_THEME}' END AS theme,
              CAST(NULL AS VARCHAR) AS person_id, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS documents
       FROM documents"""
)
def submission_defaults(spark, sf):
    """French texts bring a document of their own, the others get the empty list."""
    variant = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.lit(v.PDF).alias("media_type"), F.lit("a.pdf").alias("file_name"),
        F.lit(v.PDF_FILE_TYPE).alias("file_type"),
    )
    document = F.struct(
        F.lit("F").alias("form_no"), F.lit(True).alias("is_main"), F.lit("t").alias("title"), F.array(variant).alias("variants")
    )
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("submission_id"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("theme"),
        F.when(F.col("lang") == "fr", F.array(document)).alias("documents"),
    )
    return G.submission_defaults(docs).withColumn("documents", F.size("documents"))


@query(
    f"""SELECT o_orderkey AS application_id, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'F0' END AS form_no,
              '{v.FOLLOWUP_LANGUAGE}' AS language, '{v.FOLLOWUP_THEME}' AS theme, '{v.FOLLOWUP_TITLE}' AS title,
              CASE WHEN o_orderstatus = 'P' THEN '{v.FOLLOWUP_ATTACHMENT[0]}' ELSE o_orderstatus END AS code,
              CASE WHEN o_orderstatus = 'P' THEN '{v.FOLLOWUP_ATTACHMENT[1]}' ELSE o_orderpriority END
                AS attachment_title
       FROM orders"""
)
def followup_requests(spark, sf):
    pair = F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("title"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("application_id"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("form_no"),
        F.when(F.col("o_orderstatus") != "P", F.array(pair)).alias("attachments"),
    )
    asked = G.followup_requests(orders, "F0")
    return asked.select(
        "application_id", "form_no", "language", "theme", "title", F.explode("attachments").alias("a")
    ).select("*", "a.code", F.col("a.title").alias("attachment_title")).drop("a")
