"""JSON message bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def body_struct(value: Column | str, schema: StructType) -> Column:
    """Binary or text message body to a struct; all fields NULL where it is not JSON."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema)


def to_body(columns: Sequence[str], keep_nulls: bool = True) -> Column:
    """The named columns as one JSON object."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*columns), options)


def embedded(content: Column | str) -> Column:
    """Bytes as one line of base64; Spark's own function breaks long values into lines."""
    return F.translate(F.base64(content), "\r\n", "")
