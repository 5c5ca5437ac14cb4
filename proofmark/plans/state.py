"""Change logs and state over the driver's tables: orders are applications, lines are their changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import changes as U
from proofmark.plans import standins as S
from proofmark.plans.registry import cents, plain, query, table

# The line's columns that tell the changes of one order apart, as one number.
CHANGE_ID_SQL = """(l_linenumber * 1000000000000 + l_partkey * 10000000 + l_suppkey * 100
                    + CAST(l_quantity AS BIGINT))"""


def change_id():
    return (
        F.col("l_linenumber") * F.lit(1_000_000_000_000)
        + F.col("l_partkey") * 10_000_000
        + F.col("l_suppkey") * 100
        + F.col("l_quantity").cast("long")
    )


def apps(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("form_no"),
        F.lit("start").alias("title"),
        F.lit("nb").alias("language"),
        F.lit(0).cast("long").alias("step"),
        F.lit(v.CREATED).alias("status"),
        F.when(F.col("o_orderstatus") == "F", "A").otherwise("B").alias("app_source"),
        F.col("o_orderdate").alias("changed_at"),
    )


APPS_SQL = f"""
SELECT o_orderkey AS application_id, o_custkey AS user_id, o_orderpriority AS form_no, 'start' AS title,
       'nb' AS language, CAST(0 AS BIGINT) AS step, '{v.CREATED}' AS status,
       CASE o_orderstatus WHEN 'F' THEN 'A' ELSE 'B' END AS app_source, o_orderdate AS changed_at FROM orders
"""


def change_log(spark, sf):
    return changes_of(table(spark, sf, "lineitem"))


def changes_of(lines):
    """A line changes the order 40 keys further, so some changes meet no application."""
    flags = F.concat("l_returnflag", "l_linestatus")
    op = (
        F.when((flags == "AF") & (F.col("l_linenumber") == 7), U.DELETE)
        .when((flags == "AO") & (F.col("l_linenumber") == 7), U.EXTERNAL_DELETE)
        .when(flags.isin("AF", "AO"), U.UPDATE)
        .when(flags.isin("NF", "NO"), U.COMPLETE)
        .otherwise(U.STEP)
    )
    return lines.select(
        change_id().alias("change_id"),
        op.alias("op"),
        (F.col("l_orderkey") + 40).alias("application_id"),
        F.col("l_shipdate").alias("at"),
        F.col("l_returnflag").alias("actor"),
        F.concat(F.lit("title "), F.col("l_partkey").cast("string")).alias("title"),
        F.when(F.col("l_quantity") > 20, "en").alias("language"),
        F.col("l_linenumber").cast("long").alias("step"),
        F.when(F.col("l_quantity") > 45, 1).otherwise(0).alias("attachments"),
    )


CHANGES_SQL = f"""
SELECT {CHANGE_ID_SQL} AS change_id,
       CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 AND l_linestatus = 'F' THEN 'delete'
            WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'external_delete'
            WHEN l_returnflag = 'A' THEN 'update' WHEN l_returnflag = 'N' THEN 'completed' ELSE 'step' END AS op,
       l_orderkey + 40 AS application_id, l_shipdate AS at_ts, l_returnflag AS actor, 'title ' || l_partkey AS title,
       CASE WHEN l_quantity > 20 THEN 'en' END AS language, CAST(l_linenumber AS BIGINT) AS step,
       CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS attachments
FROM lineitem
"""


def judged_sql(only: str | None = None) -> str:
    where = "" if only is None else f" WHERE op = '{only}'"
    return f"""
apps AS ({APPS_SQL}), c0 AS (SELECT * FROM ({CHANGES_SQL}){where}),
c1 AS (SELECT c0.*, CASE WHEN a.application_id IS NULL THEN 'unknown application'
                         WHEN op = 'update' AND attachments > 0 THEN 'attachment list must be empty'
                         WHEN op = 'external_delete' AND actor <> app_source THEN 'deleted by its creator only' END AS r
       FROM c0 LEFT JOIN apps a USING (application_id)),
c AS (SELECT *, coalesce(r, CASE WHEN EXISTS (
          SELECT 1 FROM c1 d WHERE d.application_id = c1.application_id AND d.r IS NULL
            AND d.op IN ('delete', 'external_delete')
            AND (d.at_ts < c1.at_ts OR (d.at_ts = c1.at_ts AND d.change_id < c1.change_id)))
        THEN 'deleted before' END) AS reason FROM c1),
ok AS (SELECT * FROM c WHERE reason IS NULL)"""


def folded_sql(only: str | None = None) -> str:
    return f"""
WITH {judged_sql(only)},
w AS (SELECT * FROM ok WHERE op IN ('update', 'completed')
      QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY at_ts DESC, change_id DESC) = 1),
s AS (SELECT * FROM ok WHERE op = 'step'
      QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY at_ts DESC, change_id DESC) = 1),
l AS (SELECT application_id, max(at_ts) AS latest, bool_or(op IN ('delete', 'external_delete')) AS gone
      FROM ok GROUP BY 1)
SELECT a.application_id, a.user_id, a.form_no, CASE WHEN w.op IS NULL THEN a.title ELSE w.title END AS title,
       CASE WHEN w.op IS NULL THEN a.language ELSE w.language END AS language,
       CASE WHEN s.op IS NULL THEN a.step ELSE s.step END AS step,
       CASE WHEN gone THEN '{v.DELETED_BY_USER}' WHEN w.op = 'completed' THEN '{v.COMPLETED}'
            WHEN w.op = 'update' THEN '{v.CREATED}' ELSE a.status END AS status,
       a.app_source, coalesce(latest, a.changed_at) AS changed_at
FROM apps a LEFT JOIN w USING (application_id) LEFT JOIN s USING (application_id) LEFT JOIN l USING (application_id)
"""


@query(folded_sql())
def apply_changes(spark, sf):
    """All kinds of changes folded into the applications, in time order."""
    return plain(U.apply_changes(apps(spark, sf), change_log(spark, sf))[0])


@query(folded_sql("update"))
def apply_updates(spark, sf):
    return plain(U.apply_updates(apps(spark, sf), change_log(spark, sf))[0])


@query(folded_sql("completed"))
def apply_completed(spark, sf):
    return plain(U.apply_completed(apps(spark, sf), change_log(spark, sf))[0])


@query(folded_sql("step"))
def apply_step(spark, sf):
    return plain(U.apply_step(apps(spark, sf), change_log(spark, sf))[0])


@query(f"WITH {judged_sql()} SELECT application_id, change_id, op, at_ts AS at, reason FROM c WHERE reason IS NOT NULL")
def rejected_changes(spark, sf):
    rejected = U.apply_changes(apps(spark, sf), change_log(spark, sf))[1]
    return plain(rejected.select("application_id", "change_id", "op", "at", "reason"))


CREATES_SQL = f"""
WITH c AS (SELECT {CHANGE_ID_SQL} AS change_id, l_orderkey AS application_id, l_shipdate AS at_ts, l_partkey AS form_no
           FROM lineitem WHERE l_returnflag = 'N'),
r AS (SELECT *, CASE WHEN application_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
                     THEN 'application exists'
                     WHEN row_number() OVER (PARTITION BY application_id ORDER BY at_ts, change_id) > 1
                     THEN 'created twice' END AS reason FROM c)
"""


def creates(spark, sf):
    lines = change_log(spark, sf).filter(F.col("actor") == "N")
    log = lines.select(
        "change_id",
        F.lit(U.CREATE).alias("op"),
        (F.col("application_id") - 40).alias("application_id"),
        "at",
        F.regexp_extract("title", "([0-9]+)", 1).cast("long").alias("form_no"),
    )
    known = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("application_id"))
    return U.apply_creates(log, known)


@query(
    CREATES_SQL
    + f"""SELECT application_id, form_no, at_ts AS created_at, '{v.CREATED}' AS status,
                 '{v.ARCHIVE_NOT_SET}' AS archive_status FROM r WHERE reason IS NULL"""
)
def apply_creates(spark, sf):
    return plain(creates(spark, sf)[0])


@query(CREATES_SQL + "SELECT application_id, change_id, reason FROM r WHERE reason IS NOT NULL")
def rejected_creates(spark, sf):
    return creates(spark, sf)[1].select("application_id", "change_id", "reason")


@query(
    """SELECT o_orderkey AS application_id, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '5') THEN 'soknad'
              ELSE 'ettersendelse' END AS app_type,
              CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'fyllUt' WHEN '2' THEN 'dokumentinnsending'
                   WHEN '5' THEN 'lospost' ELSE 'ettersending' END AS display_type,
              substr(o_orderpriority, 1, 1) = '4' AS agency_created, CAST(0 AS BIGINT) AS step,
              CASE WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN o_orderstatus END AS app_source,
              CASE WHEN substr(o_orderpriority, 1, 1) <> '5' THEN CAST(o_custkey AS VARCHAR) END AS form_no,
              o_orderdate AS created_at, o_orderdate + INTERVAL 28 DAY AS delete_at, 'Opprettet' AS status,
              'IkkeSatt' AS archive_status
       FROM orders WHERE o_totalprice >= 1000"""
)
def create_kinds(spark, sf):
    """Orders create applications in five ways by priority; the smallest orders exist already."""
    orders = table(spark, sf, "orders")
    requests = orders.select(
        F.col("o_orderkey").alias("change_id"),
        F.col("o_orderkey").alias("application_id"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderstatus").alias("actor"),
        F.col("o_custkey").cast("string").alias("form_no"),
        F.lit(28).alias("retention_days"),
        F.substring("o_orderpriority", 1, 1).alias("way"),
    )
    kinds = ["application", "from_form", "external_followup", "task", "loose_mail"]
    parts = [U.create_changes(requests.filter(F.col("way") == str(i + 1)), k) for i, k in enumerate(kinds)]
    log = reduce(DataFrame.unionByName, parts)
    known = orders.filter("o_totalprice < 1000").select(F.col("o_orderkey").alias("application_id"))
    return plain(U.apply_creates(log, known)[0].drop("actor", "retention_days", "way"))


def order_attachments(spark, sf):
    """Orders as attachments of their customer; urgent ones carry the code users may change."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", v.OTHER_ATTACHMENT)
        .otherwise(F.col("o_orderpriority"))
        .alias("code"),
        F.col("o_orderstatus").alias("title"),
        F.lit("IkkeValgt").alias("upload_status"),
        F.lit(None).cast("string").alias("comment"),
    )


ORDER_ATTACHMENTS_SQL = f"""
SELECT o_orderkey AS id, o_custkey AS application_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN '{v.OTHER_ATTACHMENT}' ELSE o_orderpriority END AS code,
       o_orderstatus AS title, 'IkkeValgt' AS upload_status, CAST(NULL AS VARCHAR) AS comment FROM orders
"""


def attachment_changes(spark, sf):
    """Lines patch, add and remove attachments; added ones get ids past the orders'."""
    flags = F.concat("l_returnflag", "l_linestatus")
    op = (
        F.when((flags == "AF") & (F.col("l_linenumber") == 1), U.ADD)
        .when((flags == "AO") & (F.col("l_linenumber") == 2), U.REMOVE)
        .otherwise(U.PATCH)
    )
    return table(spark, sf, "lineitem").select(
        change_id().alias("change_id"),
        op.alias("op"),
        F.when(op == U.ADD, -change_id()).otherwise(F.col("l_orderkey") + 40).alias("id"),
        F.col("l_orderkey").alias("application_id"),
        F.col("l_shipdate").alias("at"),
        F.when(F.col("l_quantity") > 25, v.OTHER_ATTACHMENT).otherwise("X").alias("code"),
        F.when(F.col("l_quantity") > 10, F.col("l_partkey").cast("string")).alias("title"),
        F.when(F.col("l_returnflag") == "R", "SendSenere").when(F.col("l_returnflag") == "N", "LastetOpp").alias("upload_status"),
        F.when(F.col("l_linestatus") == "O", F.col("l_suppkey").cast("string")).alias("comment"),
    )


ATTACHMENT_CHANGES_SQL = f"""
SELECT {CHANGE_ID_SQL} AS change_id,
       CASE WHEN l_returnflag || l_linestatus = 'AF' AND l_linenumber = 1 THEN 'add'
            WHEN l_returnflag || l_linestatus = 'AO' AND l_linenumber = 2 THEN 'remove' ELSE 'patch' END AS op,
       CASE WHEN l_returnflag || l_linestatus = 'AF' AND l_linenumber = 1 THEN -{CHANGE_ID_SQL}
            ELSE l_orderkey + 40 END AS id,
       l_orderkey AS application_id, l_shipdate AS at_ts,
       CASE WHEN l_quantity > 25 THEN '{v.OTHER_ATTACHMENT}' ELSE 'X' END AS code,
       CASE WHEN l_quantity > 10 THEN CAST(l_partkey AS VARCHAR) END AS title,
       CASE l_returnflag WHEN 'R' THEN 'SendSenere' WHEN 'N' THEN 'LastetOpp' END AS upload_status,
       CASE WHEN l_linestatus = 'O' THEN CAST(l_suppkey AS VARCHAR) END AS comment
FROM lineitem
"""
JUDGED_ATTACHMENTS_SQL = f"""
WITH a AS ({ORDER_ATTACHMENTS_SQL}), c0 AS ({ATTACHMENT_CHANGES_SQL}),
c AS (SELECT c0.*, CASE WHEN op = 'add' AND c0.code <> '{v.OTHER_ATTACHMENT}' THEN 'only other attachments can be added'
                        WHEN op <> 'add' AND a.id IS NULL THEN 'unknown attachment'
                        WHEN op = 'remove' AND a.code <> '{v.OTHER_ATTACHMENT}'
                        THEN 'only other attachments can be deleted' END AS reason
      FROM c0 LEFT JOIN a ON a.id = c0.id)
"""


def last_given(c: str) -> str:
    return (
        f"(max(ROW(at_ts, change_id, {c})) FILTER (op = 'patch' AND {c} IS NOT NULL))[3] AS new_{c}"
    )


@query(
    JUDGED_ATTACHMENTS_SQL
    + f""", f AS (SELECT id, {last_given("title")}, {last_given("upload_status")}, {last_given("comment")},
                         bool_or(op = 'remove') AS removed FROM c WHERE reason IS NULL AND op <> 'add' GROUP BY id)
    SELECT a.id, a.application_id, a.code,
           CASE WHEN a.code = '{v.OTHER_ATTACHMENT}' THEN coalesce(new_title, a.title) ELSE a.title END AS title,
           coalesce(new_upload_status, a.upload_status) AS upload_status, coalesce(new_comment, a.comment) AS comment
    FROM a LEFT JOIN f USING (id) WHERE removed IS NOT TRUE
    UNION ALL SELECT id, application_id, code, title, upload_status, comment FROM c WHERE reason IS NULL AND op = 'add'"""
)
def apply_attachment_patch(spark, sf):
    return U.apply_attachment_patch(order_attachments(spark, sf), attachment_changes(spark, sf))[0]


@query(JUDGED_ATTACHMENTS_SQL + "SELECT id, change_id, op, reason FROM c WHERE reason IS NOT NULL")
def rejected_attachment_changes(spark, sf):
    rejected = U.apply_attachment_patch(order_attachments(spark, sf), attachment_changes(spark, sf))[1]
    return rejected.select("id", "change_id", "op", "reason")


@query(
    f"""WITH c AS (SELECT l_orderkey AS application_id, {CHANGE_ID_SQL} AS change_id, l_shipdate AS at_ts, l_partkey AS id
                   FROM lineitem WHERE l_returnflag = 'N'),
    k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY at_ts DESC, change_id DESC) = 1)
    SELECT id, application_id, 'sent' AS code FROM k
    UNION ALL SELECT o_orderkey, o_orderkey, o_orderpriority FROM orders
    WHERE o_orderkey NOT IN (SELECT application_id FROM k)"""
)
def replace_attachments(spark, sf):
    """An order's last completion brings its own attachment instead of the order's."""
    own = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("application_id"), F.col("o_orderpriority").alias("code")
    )
    completed = table(spark, sf, "lineitem").filter("l_returnflag = 'N'").select(
        F.col("l_orderkey").alias("application_id"),
        change_id().alias("change_id"),
        F.col("l_shipdate").alias("at"),
        F.col("l_partkey").alias("id"),
    )
    sent = completed.select("id", "application_id", "change_id", F.lit("sent").alias("code"))
    return U.replace_attachments(own, completed.drop("id"), sent)


def line_files(spark, sf):
    """Lines as files of their order; archived ones are saved now, files of parts of size 7 are deleted."""
    files = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"),
        F.col("l_orderkey").alias("attachment_id"),
        cents("l_extendedprice").alias("size"),
        "l_returnflag",
    )
    cols = ["id", "attachment_id", "size"]
    deleted = table(spark, sf, "part").filter("p_size = 7").select(F.col("p_partkey").alias("id"))
    return (
        files.filter("l_returnflag <> 'A'").select(*cols),
        files.filter("l_returnflag = 'A'").select(*cols),
        deleted,
    )


@query(
    """SELECT l_partkey AS id, l_orderkey AS attachment_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS size
       FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 7)"""
)
def apply_files(spark, sf):
    files, saved, deleted = line_files(spark, sf)
    return U.apply_files(files, order_attachments(spark, sf), saved, deleted)[0]


@query(
    f"""SELECT a.* REPLACE (CASE WHEN id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'
             AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 7))
             THEN '{v.UPLOADED}' ELSE upload_status END AS upload_status) FROM ({ORDER_ATTACHMENTS_SQL}) a"""
)
def uploaded_attachments(spark, sf):
    files, saved, deleted = line_files(spark, sf)
    return U.apply_files(files, order_attachments(spark, sf), saved, deleted)[1]


def cascade(spark, sf):
    """Customers in debt are deleted with their orders and lines."""
    apps = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("application_id"), F.lit(v.CREATED).alias("status"), "c_acctbal"
    )
    ids = apps.filter("c_acctbal < 0").select("application_id")
    files = line_files(spark, sf)
    events = table(spark, sf, "events").select(F.col("user_id").alias("submission_id"), "event_id")
    return U.cascade_delete(
        ids, apps.drop("c_acctbal"), order_attachments(spark, sf), files[0].unionByName(files[1]), events
    )


@query(
    f"""SELECT 'applications' AS state, c_custkey AS id, c_custkey AS parent,
               CASE WHEN c_acctbal < 0 THEN '{v.DELETED_BY_USER}' ELSE '{v.CREATED}' END AS status FROM customer
        UNION ALL SELECT 'attachments', o_orderkey, o_custkey, NULL FROM orders JOIN customer ON c_custkey = o_custkey
               AND c_acctbal >= 0
        UNION ALL SELECT 'files', l_partkey, l_orderkey, NULL FROM lineitem JOIN orders ON o_orderkey = l_orderkey
               JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
        UNION ALL SELECT 'notifications', event_id, user_id, NULL FROM events
               WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def cascade_delete(spark, sf):
    return cascaded(cascade(spark, sf))


def cascaded(out):
    """The four tables as one, for comparison."""
    none = F.lit(None).cast("string")

    def rows(name, id, parent, status=none):
        return out[name].select(
            F.lit(name).alias("state"), F.col(id).alias("id"), F.col(parent).alias("parent"), status.alias("status")
        )

    return (
        rows("applications", "application_id", "application_id", F.col("status"))
        .unionByName(rows("attachments", "id", "application_id"))
        .unionByName(rows("files", "id", "attachment_id"))
        .unionByName(rows("notifications", "event_id", "submission_id"))
    )


def dated(spark, sf):
    a = S.applications(spark, sf)
    return a.withColumn("delete_at", F.col("created_at") + F.make_interval(days=F.lit(28)))


@query(
    f"""SELECT application_id, created_at, CASE WHEN created_at + INTERVAL 28 DAY <= TIMESTAMP '1998-06-15'
               AND status IN ('{v.CREATED}', '{v.COMPLETED}') THEN '{v.DELETED_BY_SCHEDULE}' ELSE status END AS status
        FROM ({S.APPLICATIONS_SQL})"""
)
def expire(spark, sf):
    """Applications kept for 28 days, nightly run of 1998-06-15."""
    as_of = F.lit("1998-06-15").cast("timestamp")
    return plain(U.expire(dated(spark, sf), as_of)[0].select("application_id", "created_at", "status"))


EXPIRED_SQL = f"""
SELECT application_id FROM ({S.APPLICATIONS_SQL})
WHERE created_at + INTERVAL 28 DAY <= TIMESTAMP '1998-06-15' AND status IN ('{v.CREATED}', '{v.COMPLETED}')
"""


@query(
    f"""WITH gone AS ({EXPIRED_SQL}), line AS (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem)
        SELECT 'applications' AS state, application_id AS id, application_id AS parent,
               CASE WHEN application_id IN (FROM gone) THEN '{v.DELETED_BY_SCHEDULE}' ELSE status END AS status
        FROM ({S.APPLICATIONS_SQL})
        UNION ALL SELECT 'attachments', id, l_orderkey, NULL FROM line WHERE l_orderkey NOT IN (FROM gone)
        UNION ALL SELECT 'files', l_partkey, id, NULL FROM line WHERE l_orderkey NOT IN (FROM gone)
        UNION ALL SELECT 'notifications', event_id, user_id, NULL FROM events WHERE user_id NOT IN (FROM gone)"""
)
def expire_cascade(spark, sf):
    """The nightly run of 1998-06-15 with what belongs to the applications: orders, their lines, a file per line."""
    line = table(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    attachments = line.select("id", F.col("l_orderkey").alias("application_id"))
    files = line.select(F.col("l_partkey").alias("id"), F.col("id").alias("attachment_id"))
    events = table(spark, sf, "events").select(F.col("user_id").alias("submission_id"), "event_id")
    as_of = F.lit("1998-06-15").cast("timestamp")
    return cascaded(U.expire_cascade(dated(spark, sf), attachments, files, as_of, events))


RECEIPT_LIST_SQL = f"""
SELECT *, CASE WHEN upload_status IN ('LastetOpp', 'Innsendt') THEN 'sent'
               WHEN upload_status = 'SendSenere' THEN CASE WHEN required THEN 'to_follow' END
               WHEN upload_status = 'SendesAvAndre' THEN 'by_others'
               WHEN upload_status = 'LevertDokumentasjonTidligere' THEN 'earlier'
               WHEN upload_status IN ('SendesIkke', 'HarIkkeDokumentasjonen') THEN 'not_sent'
               WHEN upload_status = 'NavKanHenteDokumentasjon' THEN 'agency_fetches' END AS list
FROM ({S.ATTACHMENTS_SQL}) WHERE NOT is_main
"""


@query(f"SELECT application_id, line, part, code, upload_status, list FROM ({RECEIPT_LIST_SQL}) WHERE list IS NOT NULL")
def receipt_lines(spark, sf):
    lines = U.receipt_lines(S.attachments(spark, sf))
    return lines.select("application_id", "line", "part", "code", "upload_status", "list")


def submitted(spark, sf):
    days = F.ascii(F.substring("form_no", 1, 1)) - F.lit(49)
    return S.applications(spark, sf).select(
        "application_id",
        F.when(F.col("status") == v.SUBMITTED, F.col("created_at")).alias("submitted_at"),
        (days * 7).cast("long").alias("followup_days"),
    )


@query(
    f"""SELECT o_orderkey AS application_id, o_orderdate AS received_at,
               o_orderdate + to_days((CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) * 7) AS followup_until,
               count(*) FILTER (list = 'sent') AS sent, count(*) FILTER (list = 'to_follow') AS to_follow,
               count(*) FILTER (list = 'by_others') AS by_others, count(*) FILTER (list = 'earlier') AS earlier,
               count(*) FILTER (list = 'not_sent') AS not_sent,
               count(*) FILTER (list = 'agency_fetches') AS agency_fetches
        FROM orders LEFT JOIN ({RECEIPT_LIST_SQL}) ON application_id = o_orderkey
        WHERE o_orderstatus = 'F' GROUP BY ALL"""
)
def receipts(spark, sf):
    return plain(U.receipts(submitted(spark, sf), S.attachments(spark, sf)))


@query(
    f"""WITH m AS (SELECT l_orderkey AS id, (max(ROW(l_shipdate,
                 'Archiving: ' || CASE l_returnflag WHEN 'A' THEN 'OK' ELSE l_linestatus END)))[2] AS message
          FROM lineitem GROUP BY 1)
    SELECT application_id, CASE WHEN status <> '{v.SUBMITTED}' OR message IS NULL THEN '{v.ARCHIVE_NOT_SET}'
                                WHEN message LIKE '%OK' THEN '{v.ARCHIVED}' ELSE '{v.ARCHIVE_FAILED}' END AS archive_status
    FROM ({S.APPLICATIONS_SQL}) LEFT JOIN m ON id = application_id"""
)
def archive_status(spark, sf):
    text = F.when(F.col("l_returnflag") == "A", "OK").otherwise(F.col("l_linestatus"))
    feedback = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        F.concat(F.lit("Archiving: "), text).alias("message"),
        F.col("l_shipdate").alias("ts"),
    )
    state = U.archive_status(S.applications(spark, sf), feedback, "OK$")
    return state.select("application_id", "archive_status")


@query(
    """WITH s AS (SELECT l_orderkey AS key, l_shipdate AS ts, CASE l_returnflag || l_linestatus
              WHEN 'NF' THEN 0 WHEN 'NO' THEN 1 WHEN 'AF' THEN 2 WHEN 'AO' THEN 3 END AS r FROM lineitem),
    k AS (SELECT DISTINCT key FROM s WHERE r IS NOT NULL),
    n AS (SELECT unnest(range(4)) AS r),
    names AS (SELECT * FROM (VALUES (0, 'RECEIVED'), (1, 'STARTED'), (2, 'ARCHIVED'), (3, 'FINISHED')) t(r, name)),
    d AS (SELECT a.key, string_agg(DISTINCT nb.name || ' before ' || na.name, ',' ORDER BY nb.name || ' before ' || na.name)
                 AS out_of_order
          FROM s a JOIN s b ON a.key = b.key AND b.ts < a.ts AND b.r > a.r
          JOIN names na ON na.r = a.r JOIN names nb ON nb.r = b.r GROUP BY a.key),
    mx AS (SELECT key, max(r) AS top FROM s GROUP BY key),
    m AS (SELECT k.key, string_agg(name, ',' ORDER BY name) AS missing
          FROM k JOIN mx USING (key) JOIN names ON names.r < top
          WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.key = k.key AND s.r = names.r) GROUP BY k.key)
    SELECT key, coalesce(out_of_order, '') AS out_of_order, coalesce(missing, '') AS missing
    FROM k LEFT JOIN d USING (key) LEFT JOIN m USING (key) WHERE out_of_order IS NOT NULL OR missing IS NOT NULL"""
)
def lifecycle_violations(spark, sf):
    """Line flags as stages of their order."""
    return listed(U.lifecycle_violations(stages_of(table(spark, sf, "lineitem"))))


def listed(violations):
    text = lambda c: F.array_join(F.array_sort(c), ",").alias(c)
    return violations.select("key", text("out_of_order"), text("missing"))


def stages_of(lines):
    flags = F.concat("l_returnflag", "l_linestatus")
    stage = F.when(flags == "NF", "RECEIVED").when(flags == "NO", "STARTED").when(flags == "AF", "ARCHIVED").when(
        flags == "AO", "FINISHED"
    )
    return lines.select(F.col("l_orderkey").alias("key"), stage.alias("event_type"), F.col("l_shipdate").alias("ts"))
