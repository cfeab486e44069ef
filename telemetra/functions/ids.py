"""Row keys and station identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.schema import NONE_TOKEN, UUID_NAMESPACE_HEX


def uuid5(name: Column) -> Column:
    """RFC 4122 name-based UUID (version 5) of ``name`` in the DNS namespace.

    SHA-1 over namespace bytes + UTF-8 name; then the version nibble is set to 5
    and the variant bits to 10xx.
    """
    # The hash stands in the expression twice only: a filter pushed below it copies the whole chain at each place.
    h = F.sha1(F.concat(F.unhex(F.lit(UUID_NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    dashed = F.regexp_replace(h, "^(.{8})(.{4}).(.{3})(.{4})(.{12}).{8}$", "$1-$2-5$3-$4-$5")
    return F.overlay(dashed, variant, F.lit(20))


def row_uuid(tokens: list[Column]) -> Column:
    """Deterministic row key: UUIDv5 of the cells joined by ``|``.

    Cells arrive as key tokens (see ``parse.align``); a NULL still left is
    rendered ``None`` so that no cell is skipped by the join.
    """
    return uuid5(F.concat_ws("|", *[F.coalesce(t, F.lit(NONE_TOKEN)) for t in tokens]))


def prefix_station_id(c: Column, prefix: str = "&") -> Column:
    """``prefix || id``; NULL stays NULL (C11)."""
    return F.concat(F.lit(prefix), c)
