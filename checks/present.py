"""Brings both sides of a comparison to the same printable types.

Dates and timestamps become text, counts BIGINT, fractions DOUBLE with six decimals. The order in
which a distributed sum is added up shows in the last bits of a double; rounding to nine decimals
first keeps it from deciding a tie at the seventh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlens.functions.columns import round_double

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)


def shown(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, _WHOLE):
            c = c.cast("bigint")
        elif isinstance(f.dataType, _FRACTION):
            c = round_double(round_double(c.cast("double"), 9), 6)
        elif isinstance(f.dataType, T.NullType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


_SQL = {
    "d": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
    "t": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
    "i": "CAST({c} AS BIGINT)",
    "f": "round(round(CAST({c} AS DOUBLE), 9), 6)",
    "s": "CAST({c} AS VARCHAR)",
    "b": "CAST({c} AS BOOLEAN)",
}


def shown_sql(body: str, columns: str) -> str:
    """Wraps ``body``; ``columns`` lists ``name:kind`` with kinds d t i f s b."""
    out = []
    for item in columns.split():
        name, kind = item.split(":")
        out.append(_SQL[kind].format(c=f'"{name}"') + f' AS "{name}"')
    return f"SELECT {', '.join(out)} FROM ({body})"
