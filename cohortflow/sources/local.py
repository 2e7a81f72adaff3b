"""Small literal tables as JVM-side local relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A literal table (tens of rows) as a ``LocalRelation``.

    Unlike ``createDataFrame`` on a Python list, the rows live in the plan, so
    no Python worker is involved when a job reads them, and the planner knows
    their exact size when it decides to broadcast.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values}")
