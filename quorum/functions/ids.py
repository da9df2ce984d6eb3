"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_uuid() -> Column:
    """A new id for every row, for what has no key of its own, such as one load of a file."""
    return F.uuid()


def as_uuid(hexed: Column) -> Column:
    """The first 32 hexadecimal digits of a text in groups of 8-4-4-4-12."""
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(hexed, at, n) for at, n in cuts])


#: Fixed value: the salt that ids are made with where none is given.
SALT = "salt_string"


def salted_uuid(*fields: Column | str, salt: str = SALT) -> Column:
    """An id that depends on the fields' texts (null as '') and the salt: md5 of the salted texts joined by '-'."""
    cols = [F.col(f) if isinstance(f, str) else f for f in fields]
    return as_uuid(F.md5(F.concat_ws("-", *[F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit(salt)) for c in cols])))


def fingerprint(*fields: str) -> Column:
    """md5 of the fields in order; null differs from ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("~")) for f in fields]))


def household_hash(*fields: str) -> Column:
    """Unsalted sha256 of the fields as they are (null as ''): equal for one household, telling nothing else."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256)


def decode_base64_id(c: Column) -> Column:
    """The text in a base64-wrapped id; what is no base64 gives null."""
    return F.decode(F.try_to_binary(c, F.lit("base64")), "utf-8")


def election_id(office: str, candidate_office: str, level: str, kind: str, state: str, city: Column, district: Column, seat: str, date: str, special: Column, seats: Column) -> Column:
    """One id for an office's election in a year; a special election in that year has another. Null parts count as ''."""
    empty = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    year = F.concat(empty(F.year(date)), F.when(F.coalesce(special, F.lit(False)), "_special").otherwise(""))
    return salted_uuid(*map(empty, (office, candidate_office, level, kind, state, city, district, seat)), year, empty(seats))
