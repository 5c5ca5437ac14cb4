"""Small column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proofmark import values as v


def int32(value: Column) -> Column:
    """A four-byte big-endian count; counts are never negative."""
    return F.conv(F.hex(value), 16, 10).cast("int")


def without_schema_id(value: Column) -> Column:
    """A registry-framed Avro value without its magic byte and four-byte schema id."""
    return F.substring(value, 6, 2**31 - 1)


def filled(text: str, *cols: Column) -> Column:
    """``text`` with each ``{}`` replaced by a column; a null reads as "null"."""
    pieces = text.split("{}")
    parts = [F.lit(pieces[0])]
    for col, piece in zip(cols, pieces[1:], strict=True):
        parts += [F.coalesce(col.cast("string"), F.lit("null")), F.lit(piece)]
    return F.concat(*parts)


def stable_uuid(*cols: Column | str) -> Column:
    """A UUID-shaped id from the given columns; a recomputed row gets the same one.

    Each part carries its length, so that no two lists of parts read alike.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    text = F.concat_ws(
        "|", *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    )
    cut = F.substring(F.sha2(text, 256), 1, 32)
    for place in (21, 17, 13, 9):  # from the right; the hash occurs once, as nothing shares it inside a lambda
        cut = F.overlay(cut, F.lit("-"), place, 0)
    return cut


def overlaps(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> Column:
    """Closed periods share a day; a missing end is no end."""
    return (to_b.isNull() | (from_a <= to_b)) & (to_a.isNull() | (from_b <= to_a))


def notification_kind(system_generated: Column) -> Column:
    """What the system asks for is a task, what a user starts is a draft."""
    return F.when(system_generated, v.NOTIFICATION_TYPES[1]).otherwise(v.NOTIFICATION_TYPES[0])


def days_after(at: Column, days: Column) -> Column:
    """``at`` moved by whole days, time of day kept."""
    return at + F.make_interval(days=days.cast("int"))
