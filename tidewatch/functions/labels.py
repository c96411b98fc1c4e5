"""Section labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message list columns and the label prefix of each section.
SECTIONS = ("Keywords", "Sectors", "Groups", "Statuses")
SECTION_PREFIX = {"Keywords": "kw-", "Sectors": "sec-", "Groups": "g-", "Statuses": "st-"}


def section_prefix(section) -> Column:
    s = F.col(section) if isinstance(section, str) else section
    m = F.create_map(*[x for k, v in SECTION_PREFIX.items() for x in (F.lit(k), F.lit(v))])
    return m[s]


def section_label(section, value) -> Column:
    """``kw-``/``sec-``/``g-``/``st-`` + value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.concat(section_prefix(section), v)
