"""Predicates of the page and change streams."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_entry(last_page_id: Column | str) -> Column:
    """A visit entry: ``last_page_id`` null or empty."""
    return F.coalesce(_c(last_page_id), F.lit("")) == ""


def is_non_entry(last_page_id: Column | str) -> Column:
    return ~is_entry(last_page_id)


def present(obj: Column | str) -> Column:
    """A JSON object field is present: neither absent nor JSON null."""
    return _c(obj).isNotNull()
