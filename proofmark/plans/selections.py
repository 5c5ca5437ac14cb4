"""Lookups over the driver's tables: orders as applications and periods, lines as files, parts as codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark import values as v
from proofmark.operators import lookups as J
from proofmark.plans import standins as S
from proofmark.plans.registry import cents, plain, query, table

UNFOLDED = 3 << 18  # bytes of text that a task unfolds, about


@query(
    f"""SELECT * FROM ({S.APPLICATIONS_SQL}) WHERE form_no = '2-HIGH' AND app_type IN ('{v.APPLICATION_TYPES[1]}')"""
)
def applications_for_form(spark, sf):
    return plain(J.applications_for_form(S.applications(spark, sf), "2-HIGH", [v.APPLICATION_TYPES[1]]))


@query(
    f"""SELECT * FROM ({S.APPLICATIONS_SQL}) a
        WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = a.user_id AND c_acctbal < 0
                      AND CASE c_mktsegment WHEN 'BUILDING' THEN '1-URGENT' ELSE '5-LOW' END = a.form_no)"""
)
def applications_for_requests(spark, sf):
    """Customers in debt ask for one form each."""
    requests = table(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "1-URGENT").otherwise("5-LOW").alias("form_no"),
    )
    return plain(J.applications_for_requests(S.applications(spark, sf), requests))


def customer_tree(spark, sf):
    """Customers as applications, orders as attachments, lines as files."""
    apps = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("application_id"), F.col("c_name").alias("title")
    )
    attachments = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.col("o_orderpriority").alias("code"),
        F.col("o_orderstatus").alias("title"),
    )
    files = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("attachment_id"),
        F.col("l_partkey").alias("id"),
        F.col("l_shipdate").cast("date").cast("string").alias("name"),
        cents("l_extendedprice").alias("size"),
    )
    return apps, attachments, files


@query(
    """SELECT c_custkey AS application_id, c_name AS title, o_orderkey AS attachment_id, o_orderpriority AS code,
              o_orderstatus AS attachment_title, l_partkey AS file_id,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS file_name,
              CAST(round(l_extendedprice * 100) AS BIGINT) AS file_size
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey"""
)
def application_detail(spark, sf):
    return J.application_detail(*customer_tree(spark, sf))


@query(
    """SELECT o_custkey AS application_id, o_orderkey AS attachment_id, count(l_orderkey) AS files,
              CAST(coalesce(sum(CAST(round(l_extendedprice * 100) AS BIGINT)), 0) AS BIGINT) AS size
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""
)
def attachment_files(spark, sf):
    _, attachments, files = customer_tree(spark, sf)
    return J.attachment_files(attachments, files)


def stored_lines(spark, sf):
    """Lines as stored files of their part; returned ones are deleted."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"),
        cents("l_extendedprice").alias("size"),
        F.when(F.col("l_returnflag") == "R", "deleted").otherwise("ok").alias("file_status"),
    )


def part_requests(spark, sf):
    """An order asks for the files of two ids; only the small ones are parts."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.array("o_custkey", "o_orderkey").alias("ids")
    )


@query(
    """WITH a AS (SELECT o_orderkey AS request_id, 0 AS pos, o_custkey AS id FROM orders
                  UNION ALL SELECT o_orderkey, 1, o_orderkey FROM orders),
    s AS (SELECT l_partkey AS id,
                 CAST(coalesce(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (l_returnflag <> 'R'), 0)
                   AS BIGINT) AS size,
                 CAST(count(*) FILTER (l_returnflag <> 'R') AS BIGINT) AS files,
                 CASE WHEN bool_or(l_returnflag <> 'R') THEN 'ok' ELSE 'deleted' END AS file_status
          FROM lineitem GROUP BY 1)
    SELECT request_id, pos, id, coalesce(size, 0) AS size, coalesce(files, 0) AS files,
           coalesce(file_status, 'notfound') AS file_status
    FROM a LEFT JOIN s USING (id)"""
)
def files_by_ids(spark, sf):
    return J.files_by_ids(part_requests(spark, sf), stored_lines(spark, sf))


def part_files(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), cents("p_retailprice").alias("size"), F.col("p_size").alias("pages")
    )


MANIFEST_SQL = """
SELECT request_id, pos, id, CAST(round(p_retailprice * 100) AS BIGINT) AS size, p_size AS pages
FROM (SELECT o_orderkey AS request_id, 0 AS pos, o_custkey AS id FROM orders
      UNION ALL SELECT o_orderkey, 1, o_orderkey FROM orders) LEFT JOIN part ON p_partkey = id
"""


@query(MANIFEST_SQL)
def merge_manifest(spark, sf):
    return J.merge_manifest(part_requests(spark, sf), part_files(spark, sf))[0]


@query(
    f"""SELECT request_id, count(*) AS parts, CAST(count(*) FILTER (size IS NULL) AS BIGINT) AS missing,
               CAST(sum(size) AS BIGINT) AS size, CAST(sum(pages) AS BIGINT) AS pages
        FROM ({MANIFEST_SQL}) GROUP BY request_id"""
)
def merge_totals(spark, sf):
    return J.merge_manifest(part_requests(spark, sf), part_files(spark, sf))[1]


def start_requests(spark, sf):
    """Orders from 1999 on ask to start, dear ones by force; earlier orders are the applications so far."""
    apps = S.applications(spark, sf)
    cut = F.lit("1999-01-01").cast("timestamp")
    requests = apps.filter(F.col("created_at") >= cut).select(
        F.col("application_id").alias("request_id"),
        "user_id",
        "form_no",
        (F.col("amount") > 40_000_000).alias("force"),
    )
    return requests, apps.filter(F.col("created_at") < cut)


EXISTING_SQL = f"""
WITH a AS ({S.APPLICATIONS_SQL}),
r AS (SELECT application_id AS request_id, user_id, form_no, amount > 40000000 AS force FROM a
      WHERE created_at >= TIMESTAMP '1999-01-01'),
j AS (SELECT r.*, NOT force AND EXISTS (SELECT 1 FROM a WHERE a.user_id = r.user_id AND a.form_no = r.form_no
        AND a.created_at < TIMESTAMP '1999-01-01' AND a.status IN ('{v.CREATED}', '{v.COMPLETED}')) AS existing
      FROM r)
"""


@query(EXISTING_SQL + "SELECT request_id, user_id, form_no, force FROM j WHERE NOT existing")
def split_existing(spark, sf):
    """Requests that start a new application."""
    return J.split_existing(*start_requests(spark, sf))[0]


@query(
    EXISTING_SQL + f"SELECT request_id, user_id, form_no, force, '{v.ALREADY_EXISTS}' AS answer FROM j WHERE existing"
)
def already_existing(spark, sf):
    return J.split_existing(*start_requests(spark, sf))[1]


def followups(spark, sf):
    """Every order follows up its customer; urgent ones show the earlier files."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("followup_id"),
        F.col("o_custkey").alias("linked_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("show_linked"),
    )


@query(
    """WITH t AS (SELECT o_custkey AS linked_id, count(*) AS files,
                         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS size
                  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT o_orderkey AS followup_id, o_custkey AS linked_id, o_orderpriority = '1-URGENT' AS show_linked,
           CASE WHEN o_orderpriority = '1-URGENT' THEN coalesce(files, 0) ELSE 0 END AS files,
           CASE WHEN o_orderpriority = '1-URGENT' THEN coalesce(size, 0) ELSE 0 END AS size
    FROM orders LEFT JOIN t ON linked_id = o_custkey"""
)
def linked_files(spark, sf):
    _, attachments, files = customer_tree(spark, sf)
    return J.linked_files(followups(spark, sf), attachments, files)[0]


@query(
    """SELECT o_custkey AS linked_id, o_orderkey AS attachment_id, l_partkey AS file_id,
              CAST(round(l_extendedprice * 100) AS BIGINT) AS size
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def linked_file_list(spark, sf):
    _, attachments, files = customer_tree(spark, sf)
    return J.linked_files(followups(spark, sf), attachments, files)[1]


def code_rows(spark, sf):
    """Lines as rows with a code; parts up to size 25 are the code list, in a language by their type."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("row"),
        F.when(F.col("l_quantity") < 45, F.col("l_partkey")).alias("code"),
        F.when(F.col("l_returnflag") == "A", "nb").otherwise("en").alias("language"),
        F.when(F.col("l_returnflag") == "N", F.col("l_linestatus")).alias("title"),
    )
    codes = table(spark, sf, "part").filter("p_size <= 25").select(
        F.col("p_partkey").alias("code"),
        F.when(F.col("p_type") == "ECONOMY", "en").otherwise("nb").alias("language"),
        F.col("p_name").alias("title"),
    )
    return lines, codes


CODE_ROWS_SQL = """
SELECT l_orderkey AS row, CASE WHEN l_quantity < 45 THEN l_partkey END AS code,
       CASE WHEN l_returnflag = 'A' THEN 'nb' ELSE 'en' END AS language,
       CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS title FROM lineitem
"""


@query(
    f"""SELECT * FROM ({CODE_ROWS_SQL}) WHERE code IS NULL
        OR code IN (SELECT p_partkey FROM part WHERE p_size <= 25)"""
)
def validate_codes(spark, sf):
    return J.validate_codes(*code_rows(spark, sf))[0]


@query(f"SELECT * FROM ({CODE_ROWS_SQL}) WHERE code NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)")
def unknown_codes(spark, sf):
    return J.validate_codes(*code_rows(spark, sf))[1]


@query(
    f"""WITH c AS (SELECT p_partkey AS code, CASE WHEN p_type = 'ECONOMY' THEN 'en' ELSE 'nb' END AS language,
                          p_name AS title FROM part WHERE p_size <= 25)
    SELECT r.row, r.code, r.language,
           coalesce(r.title, (SELECT title FROM c WHERE c.code = r.code AND c.language = r.language),
                    (SELECT title FROM c WHERE c.code = r.code AND c.language = '{v.FALLBACK_LANGUAGE}')) AS title
    FROM ({CODE_ROWS_SQL}) r"""
)
def fill_titles(spark, sf):
    return J.fill_titles(*code_rows(spark, sf))


def periods(spark, sf):
    """Orders as activities of 60 days; those of status O have no end."""
    start = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("activity_id"),
        F.col("o_custkey").cast("string").alias("person_id"),
        start.alias("from_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(start, 60)).alias("to_date"),
    )


PERIODS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, CAST(o_custkey AS VARCHAR) AS person_id,
       CAST(o_orderdate AS DATE) AS from_date,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 60 END AS to_date FROM orders
"""


@query(
    f"""SELECT * FROM ({PERIODS_SQL}) WHERE from_date <= DATE '1998-03-01' + 60
        AND (to_date IS NULL OR to_date >= DATE '1998-01-15')"""
)
def activities_in_period(spark, sf):
    """The end defaults to 60 days from the given day."""
    day = lambda s: F.to_date(F.lit(s))
    return J.activities_in_period(periods(spark, sf), day("1998-01-15"), today=day("1998-03-01"))


def target_groups(spark, sf):
    """Orders as target-group periods of a type by priority."""
    types = F.array(*[F.lit(t) for t in v.TARGET_GROUP_TYPES[:5]])
    start = F.date_add(F.col("o_orderdate").cast("date"), 20)
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("person_id"),
        F.element_at(types, F.substring("o_orderpriority", 1, 1).cast("int")).alias("group_type"),
        F.concat(F.lit("group "), F.col("o_orderkey").cast("string")).alias("name"),
        start.alias("from_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(start, 45)).alias("to_date"),
    )


TARGET_GROUPS_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS person_id,
       ({v.TARGET_GROUP_TYPES[:5]})[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS group_type,
       'group ' || o_orderkey AS name, CAST(o_orderdate AS DATE) + 20 AS from_date,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 65 END AS to_date FROM orders
"""


@query(
    f"""SELECT * FROM ({TARGET_GROUPS_SQL}) WHERE from_date <= DATE '2099-12-31'
        AND (to_date IS NULL OR to_date >= DATE '2000-06-01')"""
)
def target_groups_in_period(spark, sf):
    return J.target_groups_in_period(target_groups(spark, sf), F.to_date(F.lit("2000-06-01")))


@query(
    f"""WITH a AS ({PERIODS_SQL}), g AS ({TARGET_GROUPS_SQL}),
    j AS (SELECT a.*, g.group_type, g.name, row_number() OVER (
              PARTITION BY a.activity_id
              ORDER BY list_position({v.TARGET_GROUP_TYPES}, g.group_type),
                       coalesce(g.to_date, DATE '9999-12-31') DESC, g.from_date DESC, g.name DESC) AS r
          FROM a LEFT JOIN g ON g.person_id = a.person_id
            AND g.from_date <= coalesce(a.to_date, DATE '9999-12-31')
            AND coalesce(g.to_date, DATE '9999-12-31') >= a.from_date)
    SELECT activity_id, person_id, from_date, to_date, group_type, name FROM j WHERE r = 1"""
)
def best_target_group(spark, sf):
    best = J.best_target_group(periods(spark, sf), target_groups(spark, sf))
    return best.select(
        "activity_id", "person_id", "from_date", "to_date", "target_group.group_type", "target_group.name"
    )


def cases(spark, sf):
    """Orders as activities with a case; the priority gives the number of decisions and payment lines."""
    n = F.ascii(F.substring("o_orderpriority", 1, 1)) - F.lit(49)
    start = F.col("o_orderdate").cast("date")
    up_to = lambda k: F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>"))
    amount = cents("o_totalprice")

    def payment(i, j):
        return F.struct(
            j.cast("string").alias("plan_id"),
            (amount + i * 10 + j).alias("amount"),
            F.date_add(start, j).alias("from_date"),
            F.date_add(start, j + 7).alias("to_date"),
            F.lit(None).cast("string").alias("journal_id"),
        )

    def decision(i):
        return F.struct(
            i.cast("string").alias("decision_id"),
            start.alias("from_date"),
            F.lit(None).cast("date").alias("to_date"),
            ((F.col("o_orderstatus") == "F") & (i == 1)).alias("daily_travel"),
            F.transform(up_to(i - 1), lambda j: payment(i, j)).alias("payment_plan"),
        )

    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("activity_id"),
        F.struct(
            F.col("o_custkey").cast("string").alias("case_id"),
            F.transform(up_to(n), decision).alias("decisions"),
        ).alias("case"),
    )


DECISIONS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, CAST(o_custkey AS VARCHAR) AS case_id, o_orderstatus, o_orderdate,
       CAST(round(o_totalprice * 100) AS BIGINT) AS amount, d.i
FROM orders LEFT JOIN (SELECT unnest(range(1, 5)) AS i) d ON d.i < CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
"""


@query(
    f"""SELECT activity_id, case_id, CAST(i AS VARCHAR) AS decision_id, CAST(j AS VARCHAR) AS plan_id,
               CASE WHEN j IS NOT NULL THEN amount + i * 10 + j END AS amount,
               CAST(o_orderdate AS DATE) + CAST(j AS INTEGER) AS from_date,
               CAST(o_orderdate AS DATE) + CAST(j + 7 AS INTEGER) AS to_date, CAST(NULL AS VARCHAR) AS journal_id
        FROM ({DECISIONS_SQL}) LEFT JOIN (SELECT unnest(range(1, 4)) AS j) ON j < i"""
)
def payment_lines(spark, sf):
    return J.payment_lines(cases(spark, sf))


@query(
    f"""SELECT activity_id, case_id, CAST(i AS VARCHAR) AS decision_id, count(j) AS lines,
               CAST(coalesce(sum(amount + i * 10 + j), 0) AS BIGINT) AS amount
        FROM ({DECISIONS_SQL}) LEFT JOIN (SELECT unnest(range(1, 4)) AS j) ON j < i GROUP BY ALL"""
)
def payment_totals(spark, sf):
    return J.payment_totals(cases(spark, sf))


@query(
    f"""SELECT activity_id, case_id, CAST(i AS VARCHAR) AS decision_id FROM ({DECISIONS_SQL})
        WHERE o_orderstatus = 'F' AND i = 1"""
)
def daily_travel(spark, sf):
    daily = J.daily_travel(cases(spark, sf))
    return daily.select("activity_id", "case.case_id", F.explode("case.decisions.decision_id").alias("decision_id"))


@query("SELECT c_name, c_mktsegment FROM customer")
def prefill(spark, sf):
    return J.prefill(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])


def nested_turns(spark, sf):
    """Each document as a submission of as many documents as it has lines, each line's words as variants.

    Unfolded, each word has its whole line as title. Texts are dealt out so finely that a file's lines fit Parquet's
    dictionary (1 MB a column); beyond it every row would be written with its line.
    """
    words = lambda x: F.transform(
        F.split(x, " "),
        lambda w: F.struct(
            w.alias("id"), F.lit(v.PDF).alias("media_type"), w.alias("file_name"), F.lit("w").alias("file_type")
        ),
    )
    documents = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            F.lit("F").alias("form_no"), (i == 0).alias("is_main"), x.alias("title"), words(x).alias("variants")
        ),
    )
    texts = table(spark, sf, "documents").select("doc_id", "lang", "text")
    tasks = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // UNFOLDED
    return texts.repartition(tasks).select(
        F.col("doc_id").cast("string").alias("submission_id"), F.col("lang").alias("theme"), documents.alias("documents")
    )


@query(
    f"""WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
    w AS (SELECT *, unnest(string_split(line, ' ')) AS word, generate_subscripts(string_split(line, ' '), 1) - 1 AS k
          FROM l)
    SELECT CAST(doc_id AS VARCHAR) AS submission_id, lang AS theme, CAST(n AS INTEGER) AS document_no,
           CAST(k AS INTEGER) AS variant_no, n = 0 AS is_main, line AS title, word AS id FROM w"""
)
def flatten_submissions(spark, sf):
    return J.flatten_submissions(nested_turns(spark, sf)).select(
        "submission_id", "theme", "document_no", "variant_no", "is_main", "title", "id"
    )
