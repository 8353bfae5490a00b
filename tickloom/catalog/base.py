"""Registry of the checkable queries: a Spark plan and, where SQL can say it, the
same result as SQL over the same tables."""
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.catalog.oracle_views import CTES
from tickloom.sources.views import Views

QUERIES = {}
ORACLES = {}


def plain_types(df):
    """Zone-less timestamps and doubles, the types the SQL side returns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def with_views(body):
    """Prefix ``body`` with the view definitions it (transitively) mentions."""
    need, todo = [], [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if re.search(rf"\b{name}\b", text) and name not in need:
                need.append(name)
                todo.append(CTES[name])
    ordered = [n for n in CTES if n in need]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + body


def query(name, sql=None):
    """Register ``fn(views) -> DataFrame`` under ``name``."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, path: plain_types(fn(Views(spark, path)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return register


def r(col, digits=6):
    """Rounded column under its own name (SQL sums may differ in the last bits)."""
    return F.round(F.col(col), digits).alias(col)


def rs(*cols, digits=6):
    """SQL text of rounded columns."""
    return ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in cols)
