"""Text functions as built-in Spark expressions.

Every function takes and returns a ``Column``; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace class of the JavaScript ``\s`` escape, spelled
# out so the Java regex here and RE2 in an oracle mean the same characters.
JS_WS_CLASS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
JS_WS_RUN = "(?![!-~])[" + JS_WS_CLASS + "]+"  # most characters fail at the first test, before the ranges of the class

# Output caps (characters).
MAX_TEXT_LEN = 5000
SNIPPET_LEN = 300
ELLIPSIS = "…"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_text(x) -> Column:
    """collapse whitespace runs to one space and trim; null -> ''."""
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), JS_WS_RUN, " "))


def truncate(x, max_len: int | None = MAX_TEXT_LEN) -> Column:
    """at most ``max_len`` chars; longer text keeps ``max_len-1`` chars + '…'; None keeps all."""
    x = _c(x)
    if max_len is None:
        return x
    return F.when(F.length(x) > max_len, F.concat(F.substring(x, 1, max_len - 1), F.lit(ELLIPSIS))).otherwise(x)


def truncate_snippet(x, max_len: int = SNIPPET_LEN) -> Column:
    """normalise; blank -> null; longer than ``max_len``: cut, back up to the
    last space if it is not at index 0, trim right, append '…'."""
    norm = normalize_text(x)
    cut = F.substring(norm, 1, max_len)
    before_space = F.regexp_extract(cut, r"(?s)^(.+) [^ ]*$", 1)
    safe = F.when(before_space == "", cut).otherwise(before_space)
    return (
        F.when(norm == "", F.lit(None).cast("string"))
        .when(F.length(norm) <= max_len, norm)
        .otherwise(F.concat(F.rtrim(safe), F.lit(ELLIPSIS)))
    )


def js_parse_int(x) -> Column:
    """leading integer (after optional whitespace and sign) or null."""
    digits = F.regexp_extract(_c(x), r"^[" + JS_WS_CLASS + r"]*([+-]?[0-9]+)", 1)
    return digits.try_cast("bigint")  # null for ''


def slugify(x) -> Column:
    """lower-case; runs outside [a-z0-9] -> '-'; trim '-'."""
    s = F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "-")
    s = F.regexp_replace(s, "-+", "-")
    return F.regexp_replace(s, "^-|-$", "")


def file_size_text(x) -> Column:
    """first '<number> <unit>' with unit KB/MB/GB/Byte(s) (comma or dot decimals)."""
    m = F.regexp_extract(_c(x), r"(?i)([0-9]+(?:[.,][0-9]+)?[" + JS_WS_CLASS + r"]*(?:KB|MB|GB|Bytes?))", 1)
    return F.nullif(m, F.lit(""))


CHOICE_LINE_RE = r"^(.*)\(([0-9][^()]*?)\)[" + JS_WS_CLASS + r"]*$"


def split_choice_line(x) -> tuple[Column, Column]:
    """a last bracket starting with a digit is the rating, the rest the title;
    otherwise the whole line is the title.  Returns (title, rating)."""
    x = _c(x)
    title = F.regexp_extract(x, CHOICE_LINE_RE, 1)
    rating = F.regexp_extract(x, CHOICE_LINE_RE, 2)
    has = F.regexp_like(x, F.lit(CHOICE_LINE_RE))
    return F.when(has, F.trim(title)).otherwise(x), F.when(has, F.trim(rating))


# Answer prefixes removed from a quiz's right-answer text, in order.
ANSWER_PREFIXES = [
    r"(?i)^The correct answers?[" + JS_WS_CLASS + r"]+(?:is|are)[" + JS_WS_CLASS + r"]*:[" + JS_WS_CLASS + r"]*",
    r"(?i)^Die richtigen?[" + JS_WS_CLASS + r"]+(?:Antwort(?:en)?)[" + JS_WS_CLASS + r"]*(?:ist|sind)["
    + JS_WS_CLASS + r"]*:[" + JS_WS_CLASS + r"]*",
]


def strip_answer_prefix(x) -> Column:
    """F16: drop an English, then a German 'correct answer is:' prefix."""
    out = _c(x)
    for p in ANSWER_PREFIXES:
        out = F.regexp_replace(out, p, "")
    return out


# Redaction patterns and replacements, applied in this order.
EMAIL_RE = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
EMAIL_REPLACEMENT = "user@example.test"
TOKEN_RE = r"(?i)(sesskey|logintoken|authtoken)=([^&\"'<>" + JS_WS_CLASS + r"]+)"
COOKIE_RE = r"(?i)(MoodleSession\w*|MOODLEID\w*)=([^;\"'" + JS_WS_CLASS + r"<>]+)"
JSON_SESSKEY_RE = r"(?i)\"sesskey\"[" + JS_WS_CLASS + r"]*:[" + JS_WS_CLASS + r"]*\"[^\"]+\""
JSON_WWWROOT_RE = r"(?i)\"wwwroot\"[" + JS_WS_CLASS + r"]*:[" + JS_WS_CLASS + r"]*\"([^\"]+)\""
DEFAULT_EXAMPLE_ROOT = "https://lms.example.test"


def _regex_literal(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch)
    return "".join(out)


def redact_text(x, site_root: str | None = None, site_path: str | None = None,
                example_root: str = DEFAULT_EXAMPLE_ROOT) -> Column:
    """E-mails, URL tokens, session cookies, JSON sesskey and the site root
    are replaced, in this fixed order.  ``site_root`` (a full URL) and
    ``site_path`` (a path under any https host) are the deployment's own
    address; both are parameters, nothing site-specific is built in."""
    out = F.regexp_replace(_c(x), EMAIL_RE, EMAIL_REPLACEMENT)
    out = F.regexp_replace(out, TOKEN_RE, "$1=REDACTED")
    out = F.regexp_replace(out, COOKIE_RE, "$1=REDACTED")
    out = F.regexp_replace(out, JSON_SESSKEY_RE, '"sesskey":"REDACTED"')
    out = F.regexp_replace(out, JSON_WWWROOT_RE, '"wwwroot":"' + example_root + '"')
    if site_root:
        out = F.regexp_replace(out, "(?i)" + _regex_literal(site_root), example_root)
    if site_path:
        out = F.regexp_replace(
            out, r"(?i)https://[^\"'" + JS_WS_CLASS + "<>]+" + _regex_literal(site_path), example_root
        )
    return out


def mask_sesskey(x) -> Column:
    """``sesskey=<value>`` in a URL becomes ``sesskey=REDACTED``."""
    return F.regexp_replace(_c(x), "sesskey=[^&" + JS_WS_CLASS + "]+", "sesskey=REDACTED")
