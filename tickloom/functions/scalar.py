"""Null-safe casts, time text and JSON helpers as column expressions."""
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(x):
    return F.col(x) if isinstance(x, str) else x


def safe_float(x):
    """Number, 0.0 where null or not a number."""
    return F.coalesce(_col(x).try_cast("double"), F.lit(0.0))


def safe_float_nullable(x):
    return _col(x).try_cast("double")


def safe_int(x):
    """Whole number (numbers truncate, decimal text is rejected), 0 otherwise."""
    return F.coalesce(_col(x).try_cast("int"), F.lit(0))


def pearson(x, y):
    """Correlation over the pairs without nulls as an aggregate: NaN where a side does not vary (``corr`` divides by zero
    there, an error in ANSI mode), null without pairs."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    shared = F.covar_pop(x, y)
    return F.when(shared.isNotNull(), F.coalesce(F.try_divide(shared, spread), F.lit(float("nan"))))


def utc_text(time):
    """2025-08-08T12:30:00+00:00, null stays null."""
    return F.date_format(_col(time), "yyyy-MM-dd'T'HH:mm:ssxxx")


def to_utc(time, zone=None):
    """Zone-less times are read as UTC unless a zone is named."""
    return _col(time).cast("timestamp") if zone is None else F.to_utc_timestamp(_col(time).cast("timestamp"), zone)


def json_text(x, pretty=False):
    """JSON of a nested column; nulls are kept, as the documents require."""
    return F.to_json(_col(x), {"ignoreNullFields": "false", **({"pretty": "true"} if pretty else {})})


def json_number(text, path):
    return F.get_json_object(_col(text), path).try_cast("double")


def json_has_key(text, key):
    return F.array_contains(F.json_object_keys(_col(text)), key)


def first_present(text, paths):
    """Value of the first of several alternative JSON paths that exists."""
    return F.coalesce(*[F.get_json_object(_col(text), p) for p in paths])


def non_snake_case_fields(schema, prefix=""):
    """Names in a (nested) schema that are not snake_case; plan-time only."""
    import re
    bad = []
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            if not re.fullmatch(r"[a-z0-9]+(_[a-z0-9]+)*", f.name):
                bad.append(prefix + f.name)
            bad += non_snake_case_fields(f.dataType, prefix + f.name + ".")
    elif isinstance(schema, T.ArrayType):
        bad += non_snake_case_fields(schema.elementType, prefix)
    elif isinstance(schema, T.MapType):
        bad += non_snake_case_fields(schema.valueType, prefix)
    return bad


def find_nth_sunday(year, month, n):
    """Date of the n-th Sunday of a month (column expressions)."""
    first = F.make_date(_col(year), _col(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "SUN"), 7 * (n - 1))


def is_us_dst(day):
    """Second Sunday of March <= day < first Sunday of November."""
    day = _col(day)
    y = F.year(day)
    return (day >= find_nth_sunday(y, F.lit(3), 2)) & (day < find_nth_sunday(y, F.lit(11), 1))
