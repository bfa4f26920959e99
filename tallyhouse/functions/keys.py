"""Surrogate keys and import ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# They are part of hashed text, so keys only match when these do.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
IMPORT_ID_SALT = "pvd"
IMPORT_ID_LENGTH = 36


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the columns' text joined by ``-``; NULL has its own marker text.

    Pass only strings, integers, dates, timestamps and fixed-scale decimals: the
    text of a double differs between engines.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def import_id(ident: Column | str, salt: str = IMPORT_ID_SALT, length: int = IMPORT_ID_LENGTH) -> Column:
    """Leading hex digits of the salted sha-256 of an id."""
    return F.left(F.sha2(F.concat(F.lit(salt), _col(ident)), 256), F.lit(length))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
