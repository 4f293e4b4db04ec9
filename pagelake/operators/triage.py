"""Response triage — status class, login detection, capture
report and counts (the job-level form of the per-call error mapping)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mask_sesskey
from ..functions.urls import cookie_names

LOGIN_FORM_200 = r'(?i)<form[^>]+action="[^"]*/login/index\.php'
LOGIN_FORM_FILE = r"(?i)<form[^>]+action=[\"'][^\"']*/login/index\.php"
LOGIN_FORM_CAPTURE = r"(?i)<form[^>]+(?:id=[\"']login[\"']|action=[\"'][^\"']*/login/index\.php)"


def status_class(status: Column) -> Column:
    """P6: '2xx', '3xx' or 'other'."""
    return F.when(status.between(200, 299), F.lit("2xx")).when(status.between(300, 399), F.lit("3xx")).otherwise(F.lit("other"))


def is_login_redirect(status: Column, location: Column, body: Column) -> Column:
    """A 3xx whose location points at the login page, or a 200 that serves the login form."""
    loc = F.coalesce(location, F.lit(""))
    return (F.when(status.between(300, 399), F.contains(loc, F.lit("/login/index.php")) | F.contains(loc, F.lit("/login/?")))
            .when(status == 200, F.coalesce(body.rlike(LOGIN_FORM_200), F.lit(False)))
            .otherwise(F.lit(False)))


def is_login_download(content_type: Column, body: Column) -> Column:
    """P8 for files: an HTML response that holds the login form."""
    return F.coalesce(F.lower(content_type).startswith("text/html"), F.lit(False)) & F.coalesce(
        body.rlike(LOGIN_FORM_FILE), F.lit(False))


def capture_report(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Q7 (+ P6, P8): one report row per response; secrets in the URL are masked."""
    h = F.col("headers")
    ct = h["content-type"]
    return df.select(
        *keep,
        F.col("status").alias("http_status"),
        mask_sesskey(F.col("url")).alias("url"),
        ct.alias("content_type"),
        F.length(F.coalesce(F.col("body"), F.lit(""))).cast("bigint").alias("body_length"),
        F.array_join(cookie_names(h["set-cookie"]), ",").alias("set_cookie_names"),
        F.col("status").isin(302, 303).alias("redirect_status"),
        F.coalesce(ct.rlike("(?i)text/html"), F.lit(False)).alias("html_content_type"),
        F.coalesce(F.col("body").rlike(LOGIN_FORM_CAPTURE), F.lit(False)).alias("login_form"),
        status_class(F.col("status")).alias("status_class"),
        is_login_redirect(F.col("status"), h["location"], F.col("body")).alias("login"),
    )


def triage_counts(report: DataFrame) -> DataFrame:
    """Responses per status class and login outcome (partial aggregation first)."""
    return report.groupBy("status_class", "login").agg(F.count("*").alias("responses"))
