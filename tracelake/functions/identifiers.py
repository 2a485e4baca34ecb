"""Segment ids and the text keys built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of a UUID.
_HYPHENATED = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
UUID_PATTERN = (
    rf"\A(?:[0-9a-fA-F]{{32}}|{_HYPHENATED}|\{{{_HYPHENATED}\}}|urn:uuid:{_HYPHENATED})\z"
)


def _hyphenate(hex32: Column) -> Column:
    parts = [F.substring(hex32, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def normalize_uuid(text: Column) -> Column:
    """Lower-case hyphenated form, or null where the text is not a UUID."""
    canonical = F.lower(text)
    bare = F.translate(F.replace(canonical, F.lit("urn:uuid:"), F.lit("")), "{}-", "")
    return (
        F.when(~text.rlike(UUID_PATTERN), F.lit(None).cast("string"))
        .when(F.length(text) == 36, canonical)
        .otherwise(_hyphenate(bare))
    )


def uuid_from_bytes(raw: Column) -> Column:
    """Text form of a 16-byte id, null for any other length."""
    return F.when(F.octet_length(raw) == 16, _hyphenate(F.lower(F.hex(raw))))


def uuid_to_bytes(text: Column) -> Column:
    return F.unhex(F.replace(text, F.lit("-"), F.lit("")))


def table_key(segment_id: Column, source: Column, message: Column) -> Column:
    """``segment/source/message``."""
    return F.concat(segment_id, F.lit("/"), source, F.lit("/"), message)


def key_string(segment_id: Column, source: Column, message: Column, signal: Column) -> Column:
    """``segment/source/message.signal``."""
    return F.concat(table_key(segment_id, source, message), F.lit("."), signal)


def table_name(segment_id: Column, source: Column, message: Column) -> Column:
    """Quoted two-part table name ``"segment"."source/message"``."""
    return F.concat(
        F.lit('"'), segment_id, F.lit('"."'), source, F.lit("/"), message, F.lit('"')
    )
