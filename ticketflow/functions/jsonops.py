"""JSON text columns: field reads that turn bad input into NULL, never a failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeops import ColLike, _c


def text(s: ColLike, field: str) -> Column:
    """PARSE_JSON(s):field::string."""
    return F.get_json_object(_c(s), f"$.{field}")


def number(s: ColLike, field: str) -> Column:
    """PARSE_JSON(s):field::NUMBER as BIGINT (NUMBER(38,0) rounds, then narrows)."""
    return text(s, field).try_cast("decimal(38,0)").try_cast("bigint")


def is_bad(s: ColLike) -> Column:
    """True for text that is present but is not a JSON document."""
    return _c(s).isNotNull() & F.try_parse_json(_c(s)).isNull()
