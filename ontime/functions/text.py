"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space; SQL trim() alone removes only blanks.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def capitalize(c: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def title_case(c: Column) -> Column:
    """Upper case after every non-letter, so ``o'higgins-sur`` becomes ``O'Higgins-Sur``.

    ``initcap`` only looks at blanks and would give ``O'higgins-sur``.
    """
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_CASED_RUNS), F.lit(0)), capitalize), "")


def normalize_category(c: Column, null_tokens: Iterable[str] = ()) -> Column:
    """Strip and capitalize; texts listed in ``null_tokens`` (compared in lower case) become null."""
    stripped = strip(c)
    tokens = [t.lower() for t in null_tokens]
    if tokens:
        stripped = F.when(~F.lower(stripped).isin(tokens), stripped)
    return capitalize(stripped)


def padded(c: Column) -> Column:
    """One blank on each side; null stays null."""
    return F.concat(F.lit(" "), c, F.lit(" "))
