"""Row ids that follow from a row's key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace all tables' namespaces derive from. Fixed value: a change gives every stored row another id.
ROOT = uuid.uuid5(uuid.NAMESPACE_DNS, "ledgerlane")


def key_text(*columns: Column | str) -> Column:
    """A key as text that no other key gives: each part with its length, NULL as a dash."""
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts) if parts else F.lit("")


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """The name-based (version 5) UUID of a text: the same wherever and whenever it is computed, unlike ``uuid()``."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    # The top two bits of the fourth group are fixed, so its first digit is 8, 9, a or b.
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    groups = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3))]
    groups += [F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat_ws("-", *groups)


def row_id(table: str, *key: Column | str) -> Column:
    """The id of a table's row with the given key."""
    return uuid5(uuid.uuid5(ROOT, table), key_text(*key))
