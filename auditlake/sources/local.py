"""Small frames from driver-side rows, as a local relation: no task reads them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.sqltext import ident, literal

# Rows up to which a lookup is broadcast. Lookup documents are held on the driver,
# so their row count is known; a larger one is joined without a hint and AQE
# splits hot keys.
MAX_BROADCAST_ROWS = 100_000
# Rows up to which a frame is written as SQL text.
MAX_SQL_ROWS = 2_000


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """Frame of JSON scalars, in the given types."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    if len(rows) > MAX_SQL_ROWS:
        # too long for SQL text; these rows are shipped to the JVM instead
        return spark.createDataFrame([tuple(r) for r in rows], schema)
    names = schema.fieldNames()
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(ident(n) for n in names)})")
    return frame.select(*[F.col(ident(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def small(frame: DataFrame, rows: int) -> DataFrame:
    """Broadcast a lookup of a known row count, when it is small enough."""
    return F.broadcast(frame) if rows <= MAX_BROADCAST_ROWS else frame
