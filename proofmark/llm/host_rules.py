"""Quality rules with verdicts per host, in DataFrame functions only.

Each document is measured by itself. Rule failures are counted by host, the host's failure rate is shrunk towards
the rate of all hosts with an empirical beta prior (moments over the hosts), and the verdict is joined back: on a
host whose shrunk rate is too high the strict rules count as well, elsewhere only the base rules reject. A document
that passes every rule is kept on any host.

Defined cases: null text counts as empty (no words, base rule fails); a null host is a host of its own; a very
long text is measured whole within its row; of equal lines and windows the first one counts as the rules say; hosts with
equal counts get equal verdicts; repeated rows are measured and judged one by one; an empty table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import SPACE, maybe_broadcast, rowed, unrowed, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Strict rules, which count on bad hosts only.
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_LINES_PERCENT = 30
MIN_MEAN_CHARS, MAX_MEAN_CHARS = 3, 10
# A host is bad if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def measured(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the columns of ``MEASURES`` and ``n_lines``, the lines that hold a word."""
    df = df.withColumn("_text", F.coalesce(text, F.lit(""))).withColumn("_words", words_of(F.col("_text")))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), has_word)).withColumn(
        "_hashes",
        F.when(
            F.size("_words") >= 3,
            F.transform(
                F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Few texts repeat a window at all; only these sort their windows.
    marked = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    df = df.withColumn(
        "_sorted",
        F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), marked).otherwise(
            F.array().cast("array<struct<h:bigint,p:int>>")
        ),
    )
    same = lambda x, i: F.coalesce(F.get("_sorted", i)["h"] == x["h"], F.lit(False))
    df = df.withColumn(
        "_at",
        F.sort_array(
            F.transform(F.filter("_sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"])
        ),
    )
    covered = F.transform("_at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_at", i + 1), p + 3) - p))
    return df.select(
        *[c for c in df.columns if c not in {"_text", "_words", "_lines", "_hashes", "_sorted", "_at"}],
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def strict_failed() -> Column:
    return (
        (F.lit(100) * F.col("n_symbols") > F.lit(MAX_SYMBOLS_PERCENT) * F.col("n_words"))
        | (F.lit(100) * F.col("n_dup_lines") > F.lit(MAX_DUP_LINES_PERCENT) * F.col("n_lines"))
        | (F.col("word_chars") < F.lit(MIN_MEAN_CHARS) * F.col("n_words"))
        | (F.col("word_chars") > F.lit(MAX_MEAN_CHARS) * F.col("n_words"))
    )


def host_verdicts(judged: DataFrame, host: Column) -> DataFrame:
    """One row per host: _host, n_docs, n_failed, rate (shrunk), host_failed.

    The prior Beta(a, b) has the mean m of all documents and, where the hosts' rates vary more than a common rate
    explains, a + b = m(1 - m)/v - 1 of their variance v; with no such variance every host gets the common rate.
    """
    hosts = judged.groupBy(host.alias("_host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum((F.col("base_failed") | F.col("strict_failed")).cast("long")).alias("n_failed"),
    )
    hosts = written(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    n, f, ff = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.sum(rate * F.col("n_failed"))).first()
    mean = f / n if n else 0.0
    spread, var = mean * (1 - mean), (ff / n if n else 0.0) - mean**2
    if var > spread * 1e-9:
        weight = max(spread / var - 1, 0.0)
        shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    else:
        shrunk = F.lit(mean)
    return hosts.withColumn("rate", shrunk).withColumn("host_failed", F.col("rate") > MAX_HOST_RATE)


def _judged(docs: DataFrame, doc_id: str, text: str, host: str, whole_rows: bool) -> DataFrame:
    rows = rowed(docs) if whole_rows else rowed(docs.select(doc_id, text, host))
    table = measured(rows, F.col("_row").getField(text))
    table = table.withColumn("base_failed", base_failed()).withColumn("strict_failed", strict_failed())
    if not whole_rows:  # the measures go on, the texts stay behind
        table = table.withColumn(
            "_row", F.struct(F.col("_row").getField(doc_id).alias(doc_id), F.col("_row").getField(host).alias(host))
        )
    table = written(table, "host-rules")
    hosts = host_verdicts(table, F.col("_row").getField(host)).select("_host", "host_failed")
    return table.join(
        maybe_broadcast(hosts), F.col("_row").getField(host).eqNullSafe(F.col("_host"))
    ).withColumn("kept", ~F.col("base_failed") & ~(F.col("host_failed") & F.col("strict_failed")))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: its id, the measures, ``base_failed``, ``kept`` and ``host_failed``."""
    return _judged(docs, doc_id, text, host, whole_rows=False).select(
        F.col("_row").getField(doc_id).alias(doc_id), *MEASURES, "base_failed", "kept", "host_failed"
    )


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    return unrowed(_judged(docs, doc_id, text, host, whole_rows=True).filter("kept"), docs.columns)
