"""Text used by reports and table definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME_WIDTH = 15


def report_name(name: Column | str, width: int = NAME_WIDTH) -> Column:
    """A table name as a report shows it: padded, and cut, to a fixed width."""
    return F.rpad(F.lit(name) if isinstance(name, str) else name, width, " ")


def ddl_type(dtype: T.DataType) -> str:
    """The type name used when a schema is copied: user-defined types become text."""
    return "string" if isinstance(dtype, T.UserDefinedType) else dtype.simpleString()

