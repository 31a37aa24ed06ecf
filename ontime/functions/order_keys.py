"""Repeatable pseudo-random ordering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 16


def hash_key(key: Column, seed: int) -> Column:
    """Sort key that shuffles rows the same way on every run and every engine.

    Sixteen hex digits of md5(key#seed), then the key itself so that equal digits still sort one way.
    """
    text = key.cast("string")
    digits = F.substring(F.md5(F.concat(text, F.lit(f"#{seed}"))), 1, HASH_DIGITS)
    return F.concat(digits, text)
