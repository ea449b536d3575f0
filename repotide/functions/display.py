"""Columns for showing a repository."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where a repository's page is.
REPOSITORY_BASE_URL = "https://github.com/"


def repo_url(repo_name: Column, base: str = REPOSITORY_BASE_URL) -> Column:
    return F.concat(F.lit(base), repo_name, F.lit("/"))


def languages_text(languages: Column, separator: str = "") -> Column:
    """Languages in one string; NULL if the list is NULL."""
    return F.array_join(languages, separator)


def flag_text(flag: Column) -> Column:
    """``True`` or ``False``."""
    return F.initcap(flag.cast("string"))


def number_text(number: Column) -> Column:
    return number.cast("string")
