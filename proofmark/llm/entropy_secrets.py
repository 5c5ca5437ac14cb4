"""Secret scans by sliding-window Shannon entropy, in DataFrame functions only.

Fixed patterns give the base spans. Candidate strings (long runs of key characters with a letter and a digit) are
then read with a window of ``WINDOW`` characters: one character enters and one leaves, the counts of these two alone
change the sum of c*log2(c), and the entropy follows from it. Runs of windows above the threshold of the candidate's
character class (hex digits, or any) become spans of kind ``entropy``. Candidates on the allow list have none, and a
placeholder word allows itself only: what stands before and after it is scanned by itself. A run that one base span
holds is known; any other stays beside the base spans, so that no part of a longer secret is left.

Very long texts and texts with very many matches take time in proportion, but for a factor of the square root of their
matches: running sums over a list are told in two levels (``running``), candidates are read in stretches of
``STRETCH`` windows, and no text is cut out of another by its place.

Defined cases: null text counts as empty (no spans); offsets are code points, ends exclusive; matches of one kind never
overlap, spans of different kinds may; equal starts are told by kind; repeated rows are scanned one by one; an empty
table gives an empty result; extra columns never clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import rowed

# Fixed patterns and lengths of the base kinds, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Bits per character that a window needs, by class of the candidate.
HEX_BITS, ANY_BITS = 3.0, 3.7
# Candidates that are no secrets: UUIDs, words and numbers joined by punctuation, placeholders.
ALLOW = [
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[+/_=-]*([A-Za-z]?[a-z]+|[A-Z]+|[0-9]+)([+/_=-]+([A-Za-z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_=-]*$",
    r"(?i)example|placeholder|your_|xxxx|0123456789",
]
PLACEHOLDER = ALLOW[-1]
# What the second of them never has: a digit beside a letter, a capital behind a small letter, or a word with two
# capitals and then a small letter. Looked for in this way, a candidate of any length needs no backtracking.
NO_WORDS = r"[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z]|[A-Z][A-Z][a-z]"
MASK = "[SECRET]"

STRETCH = 512  # windows read in one go
SPAN = "array<struct<start:int,end:int>>"
PIECE = "array<struct<start:int,end:int,piece:string>>"


def let(value: Column, of) -> Column:
    """``of(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def running(items: Column, zero: Column, step, out, kind: str) -> Column:
    """``out(state before, item)`` of each item, where ``step(state, item)`` leads from state to state.

    A list that grows by one element is copied each time, so one level of n items would cost n squared. Here the states
    at every square root of n items are told first, then each stretch by itself.
    """

    def told(x):
        n = F.size(x)
        width = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), n - 1, width), lambda i: F.slice(x, i + 1, width))
        return let(parts, of_parts)

    def of_parts(parts):
        starts = F.aggregate(
            parts,
            F.struct(zero.alias("s"), F.array(zero).alias("all")),
            lambda a, part: let(F.aggregate(part, a["s"], step), lambda s: F.struct(s.alias("s"), F.array_append(a["all"], s).alias("all"))),
            lambda a: a["all"],
        )
        none = F.array().cast(f"array<{kind}>")
        one = lambda a, item: F.struct(step(a["s"], item).alias("s"), F.array_append(a["out"], out(a["s"], item)).alias("out"))
        stretch = lambda part, start: F.aggregate(part, F.struct(start.alias("s"), none.alias("out")), one, lambda a: a["out"])
        return F.flatten(F.zip_with(parts, F.slice(starts, 1, F.size(parts)), stretch))

    return let(items, lambda x: F.when(F.size(x) > 0, told(x)).otherwise(F.array().cast(f"array<{kind}>")))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Each match as (start, end, piece, value), each gap before one as (from, gap), from a split by the same pattern.

    The text behind the last match is the last element, with a null piece.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("g"), found.alias("f"), values.alias("v"))
    of = lambda c: F.coalesce(F.char_length(c), F.lit(0))

    def out(at, x):
        start = at + of(x["g"])
        return F.struct(
            start.alias("start"), (start + of(x["f"])).alias("end"), x["f"].alias("piece"), of(x["v"]).alias("value"), at.alias("from"), x["g"].alias("gap")
        )

    kind = "struct<start:int,end:int,piece:string,value:int,from:int,gap:string>"
    return running(zipped, F.lit(0), lambda at, x: at + of(x["g"]) + of(x["f"]), out, kind)


def _pieces(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Matches as (start, end, piece), of those whose ``group`` has at least so many characters."""
    kept = F.filter(_matches(text, pattern, group), lambda x: x["piece"].isNotNull() & (x["value"] >= least))
    found = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["piece"].alias("piece")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(PIECE))


def _spans(pieces: Column) -> Column:
    return F.transform(pieces, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def _between(piece: Column, start: Column, pattern: str) -> Column:
    """The parts of a piece before, between and behind the matches in it."""
    parts = F.transform(
        _matches(piece, pattern),
        lambda x: F.struct((start + x["from"]).alias("start"), (start + x["start"]).alias("end"), x["gap"].alias("piece")),
    )
    whole = F.array(F.struct(start.alias("start"), (start + F.char_length(piece)).alias("end"), piece.alias("piece")))
    return F.when(piece.rlike(pattern), parts).otherwise(whole)


def _plogp(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _times(char: Column, of: Column, n: int) -> Column:
    """How often a character occurs in a string of ``n``."""
    return F.lit(n) - F.char_length(F.replace(of, char, F.lit("")))


def _hot_starts(stretch: Column, most: Column) -> Column:
    """The windows of a stretch with a sum of c*log2(c) of at most ``most``, by their first character."""
    window = F.substr(stretch, F.lit(1), F.lit(WINDOW))
    first = F.aggregate(
        F.split(window, ""), F.lit(0.0), lambda s, c: s + F.when(c == "", 0.0).otherwise(F.log2(F.greatest(_times(c, window, WINDOW), F.lit(1)).cast("double")))
    )

    def step(a, at):  # from the window that begins at ``at`` (the first is 1) to the next
        leaving, entering = F.substr(stretch, at, F.lit(1)), F.substr(stretch, at + WINDOW, F.lit(1))
        rest = F.substr(stretch, at + 1, F.lit(WINDOW - 1))
        out, into = _times(leaving, rest, WINDOW - 1), _times(entering, rest, WINDOW - 1)
        total = a["sum"] - _plogp(out + 1) + _plogp(out) - _plogp(into) + _plogp(into + 1)
        return let(total, lambda t: F.struct(t.alias("sum"), F.array_append(a["all"], t).alias("all")))

    n = F.char_length(stretch) - WINDOW
    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    sums = let(first, lambda s: F.aggregate(steps, F.struct(s.alias("sum"), F.array(s).alias("all")), step, lambda a: a["all"]))
    return F.filter(F.transform(sums, lambda s, k: F.when(s <= most, k)), lambda k: k.isNotNull())


def hot_runs(piece: Column, start: Column) -> Column:
    """Joined runs of windows with enough entropy, as (start, end); ``start`` is the piece's own."""
    bits = F.when(piece.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(HEX_BITS)).otherwise(F.lit(ANY_BITS))
    most = (F.lit(math.log2(WINDOW)) - bits) * WINDOW + 1e-9  # of the sum of c*log2(c)
    begins = F.sequence(F.lit(0), F.char_length(piece) - WINDOW, F.lit(STRETCH))

    def of(most):
        stretch = lambda k: let(F.substr(piece, k + 1, F.lit(STRETCH + WINDOW - 1)), lambda x: F.transform(_hot_starts(x, most), lambda w: w + k))
        return let(F.flatten(F.transform(begins, stretch)), joined)

    def joined(hot):  # windows that overlap or touch are one run
        first = F.filter(hot, lambda w, i: (i == 0) | (w > F.get(hot, i - 1) + WINDOW))
        last = F.filter(hot, lambda w, i: (i == F.size(hot) - 1) | (F.get(hot, i + 1) > w + WINDOW))
        return F.zip_with(first, last, lambda a, b: F.struct((start + a).alias("start"), (start + b + WINDOW).alias("end")))

    return let(most, of)


def _entropy(text: Column, base: Column) -> Column:
    uuid = ALLOW[0]
    mixed = lambda piece: piece.rlike("[0-9]") & piece.rlike("[A-Za-z]")
    secret = lambda piece: ~piece.rlike(uuid) & piece.rlike(NO_WORDS)
    none = F.array().cast(PIECE)
    wanted = F.filter(_pieces(text, CANDIDATE), lambda c: mixed(c["piece"]) & secret(c["piece"]))
    parts = F.flatten(F.transform(wanted, lambda c: _between(c["piece"], c["start"], PLACEHOLDER)))
    long = F.filter(F.coalesce(parts, none), lambda c: (c["end"] - c["start"] >= WINDOW) & secret(c["piece"]))
    return let(F.flatten(F.transform(long, lambda c: hot_runs(c["piece"], c["start"]))), lambda runs: _unknown(runs, base))


def _unknown(runs: Column, base: Column) -> Column:
    """Runs that no base span holds: along the starts, none that began before reaches as far."""
    mark = lambda of, run: F.transform(of, lambda s: F.struct(s["start"].alias("start"), F.lit(run).alias("run"), s["end"].alias("end")))
    placed = F.sort_array(F.concat(mark(base, False), mark(runs, True)))
    reach = lambda far, s: F.when(s["run"], far).otherwise(F.greatest(far, s["end"]))
    out = lambda far, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), (s["run"] & (s["end"] > far)).alias("new"))
    told = running(placed, F.lit(-1), reach, out, "struct<start:int,end:int,new:boolean>")
    return F.when(F.size(runs) > 0, _spans(F.filter(told, lambda s: s["new"]))).otherwise(F.array().cast(SPAN))


def scanned(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``_text`` and the spans of each kind in ``_assign``, ``_access``, ``_hex`` and ``_entropy``."""
    df = df.withColumn("_text", F.coalesce(text, F.lit("")))
    t = F.col("_text")
    base = {"_assign": _pieces(t, ASSIGN, 1, ASSIGN_VALUE), "_access": _pieces(t, ACCESS), "_hex": _pieces(t, HEX)}
    return df.withColumns({k: _spans(x) for k, x in base.items()}).withColumn("_entropy", _entropy(t, F.concat("_assign", "_access", "_hex")))


def _listed(kinds: list[str]) -> Column:
    """Spans as kind:start:end, by start, then kind in its order."""
    def tagged(kind):
        rank = F.lit(KINDS.index(kind)).alias("k")
        return F.transform(f"_{kind}", lambda s: F.struct(s["start"].alias("s"), rank, s["end"].alias("e")))

    spans = F.sort_array(F.concat(*[tagged(k) for k in kinds]))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, counts of the base kinds, a digest of the base spans, and all spans."""
    df = scanned(rowed(docs.select(doc_id, text)), F.col("_row").getField(text))
    return df.select(
        F.col("_row").getField(doc_id).alias(doc_id),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
    )


def _covered(spans: Column) -> Column:
    """What is left of each span behind those before it, if its start is; spans are in order."""
    far = lambda at, s: F.greatest(at, s["end"])
    out = lambda at, s: F.struct(s["start"].alias("start"), F.greatest(at, s["end"]).alias("end"), (s["start"] >= at).alias("new"))

    def closed(told):  # a span that begins inside another lengthens it
        first = F.filter(told, lambda s: s["new"])
        last = F.filter(told, lambda s, i: (i == F.size(told) - 1) | F.get(told, i + 1)["new"])
        return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return let(running(spans, F.lit(0), far, out, "struct<start:int,end:int,new:boolean>"), closed)


def _masked(text: Column, spans: Column) -> Column:
    """The text with ``MASK`` for each of the spans, which follow one another. They are taken in groups of a square root
    of them, whose stretch of the text is cut out first."""

    def told(x):
        n = F.size(x)
        width = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("int")
        begin = lambda i: F.when(i > 0, F.get(x, i - 1)["end"]).otherwise(F.lit(0))

        def group(i):
            to = F.least(i + width, n)
            low = begin(i)
            stretch = F.substr(text, low + 1, F.get(x, to - 1)["end"] - low)
            cut = lambda s: F.transform(
                F.sequence(i, to - 1), lambda k: F.concat(F.substr(s, begin(k) - low + 1, F.get(x, k)["start"] - begin(k)), F.lit(MASK))
            )
            return F.array_join(let(stretch, cut), "")

        groups = F.transform(F.sequence(F.lit(0), n - 1, width), group)
        return F.concat(F.array_join(groups, ""), F.substr(text, F.get(x, n - 1)["end"] + 1))

    return let(spans, told)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``MASK``; ``length``, if there, follows the changed texts."""
    df = scanned(rowed(docs), F.col("_row").getField(text))
    df = df.withColumn("_spans", _covered(F.sort_array(F.concat(*[f"_{k}" for k in KINDS]))))
    df = df.withColumn("_new", F.when(F.size("_spans") > 0, _masked(F.col("_text"), F.col("_spans"))).otherwise(F.col("_row").getField(text)))
    return df.select(
        *[
            F.col("_new").alias(c)
            if c == text
            else F.when(F.size("_spans") > 0, F.char_length("_new")).otherwise(F.col("_row").getField(c)).cast(docs.schema[c].dataType).alias(c)
            if c == length
            else F.col("_row").getField(c).alias(c)
            for c in docs.columns
        ]
    )
