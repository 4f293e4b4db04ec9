"""Request-row validation with the tool layer's ranges and patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Input limits of the tool layer.
MODTYPE_RE = r"^[a-z_]+$"
FORUM_MAX_LIMIT = 25
SEARCH_MAX_LIMIT = 50
QUERY_MIN, QUERY_MAX = 2, 200
SEARCH_MAX_PAGE = 20
YEAR_MIN, YEAR_MAX = 2020, 2100


def validate_requests(df: DataFrame, max_limit: int = FORUM_MAX_LIMIT) -> DataFrame:
    """Adds ``reasons`` (comma-joined failed checks, '' when none) and ``valid``.
    Checks apply to the columns present: cmid, modtype, limit, offset, query,
    page, year, month (a null optional value passes).  ``max_limit`` is that of the
    tool at hand: ``SEARCH_MAX_LIMIT`` for searches."""
    c = F.col
    checks = []
    cols = set(df.columns)
    if "cmid" in cols:
        checks.append(("cmid", c("cmid").isNull() | (c("cmid") < 1)))
    if "modtype" in cols:
        checks.append(("modtype", c("modtype").isNull() | ~c("modtype").rlike(MODTYPE_RE)))
    if "limit" in cols:
        checks.append(("limit", c("limit").isNotNull() & ((c("limit") < 1) | (c("limit") > max_limit))))
    if "offset" in cols:
        checks.append(("offset", c("offset").isNotNull() & (c("offset") < 0)))
    if "query" in cols:
        checks.append(("query", c("query").isNotNull() & ((F.length("query") < QUERY_MIN) | (F.length("query") > QUERY_MAX))))
    if "page" in cols:
        checks.append(("page", c("page").isNotNull() & ((c("page") < 0) | (c("page") > SEARCH_MAX_PAGE))))
    if "year" in cols:
        checks.append(("year", c("year").isNotNull() & ((c("year") < YEAR_MIN) | (c("year") > YEAR_MAX))))
    if "month" in cols:
        checks.append(("month", c("month").isNotNull() & ((c("month") < 1) | (c("month") > 12))))
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))
    return df.withColumn("reasons", F.array_join(reasons, ",")).withColumn("valid", F.size(reasons) == 0)
