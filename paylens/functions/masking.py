"""Masks: one expression per kind of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_id(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def last_four(value: Column) -> Column:
    """Everything but the last four characters becomes X; a value of four or fewer has nothing to show."""
    size = F.length(value)
    return F.when(size <= 4, F.repeat(F.lit("X"), size)).otherwise(F.concat(F.repeat(F.lit("X"), size - 4), F.right(value, F.lit(4))))


def hashed_mailbox(email: Column) -> Column:
    """Keep the domain, hash the user part."""
    user = F.substring_index(email, "@", 1)
    return F.concat(F.substring(F.sha2(user, 256), 1, 12), F.lit("@"), F.substring_index(email, "@", -1))


def pseudonym(entity_id: Column) -> Column:
    """The same made-up name for the same id."""
    return F.concat(F.lit("Person-"), F.substring(F.sha2(entity_id.cast("string"), 256), 1, 8))


def token(value: Column, salt: str) -> Column:
    """The same token for the same value; without the salt, short numbers could be found by trial."""
    return F.concat(F.lit("tok_"), F.substring(F.sha2(F.concat(F.lit(salt), value), 256), 1, 16))


def shape_token(value: Column) -> Column:
    """Keep the shape (letter, digit, rest) of an identifier, drop its content."""
    return F.regexp_replace(F.regexp_replace(value, "[A-Z]", "A"), "[0-9]", "9")
