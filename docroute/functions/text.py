"""Scalar expressions over plan codes, names, invoice text, senders and dates.

Patterns carry (?U) so that \\s, \\d, \\b and letter case follow Unicode, as they do for the inputs' producers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace trimmed from cells and names.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Separators dropped from a plan code.
PLAN_SEPARATORS = r"(?U)[\s\-_./\\#№＃]+"

# How a plan code looks in each kind of text.
SUBJECT_CODE = r"(?U)\b([A-Z]{2,6})\s*[-#:/_ ]?\s*(\d{1,6})([A-Z]{1,2})?\b"
NAME_CODE = r"(?iU)^\s*(?:Processed\s*-\s*)?(?:Paid\b(?:\s*-\s*|\s+))?\s*([A-Z]{2,6}\s*[- ]?\s*\d{1,6}[A-Z]{0,3})"
CODE_TAIL = r"\s*(?:[.\-_/]*\s*)?(?:(?:NO\.?|NUMBER|NUM\.?)\s*)?(?:#\s*)?(\d{1,5})(?:\s*[-_.]?\s*([A-Z]{1,3})(?!\s*\/\s*[A-Z]))?\b"
LABELLED_CODE = r"(?U)\b(?:STRATA\s+PLAN\s+|STRATA\s+)(?:(?:NO\.?|NUMBER|NUM\.?)\s*)?(?:#\s*)?([A-Z]{2,6})" + CODE_TAIL
LIST_CODE_HEAD = r"(?U)\b(?:STRATA\s+PLAN\s+|STRATA\s+)?"
ANY_PREFIX = "[A-Z]{2,6}"

# Labelled invoice numbers, in priority order.
INVOICE_NUMBER = [
    r"(?iU)Invoice\s*(?:No\.?|Number|#)\s*[:#\-]?\s*([A-Z0-9][A-Z0-9\-/_]{1,30})",
    r"(?iU)\bInv\.?\s*No\.?\s*[:#\-]?\s*([A-Z0-9][A-Z0-9\-/_]{1,30})",
    r"(?iU)\bINV[\s:#\-]+([0-9][A-Z0-9\-/_]{1,30})",
    r"(?iU)\bInvoice\s+([0-9][A-Z0-9\-/_]{1,30})",
]

# Labelled amounts, in priority order; the last tier takes its last hit.
AMOUNT = [
    r"(?iU)(?:Total\s*Due|Amount\s*Due|Balance\s*Due|Amount\s*Payable|Pay\s*This\s*Amount)\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})",
    r"(?iU)Grand\s*Total\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})",
    r"(?iU)\bTotal\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})",
]

# Characters and names a file system rejects.
INVALID_CHARS = r'[<>:"/\\|?*\x00-\x1f]'
RESERVED_NAMES = [
    "CON", "PRN", "AUX", "NUL", "COM1", "COM2", "COM3", "COM4", "COM5", "COM6", "COM7", "COM8", "COM9",
    "LPT1", "LPT2", "LPT3", "LPT4", "LPT5", "LPT6", "LPT7", "LPT8", "LPT9",
]
MAX_NAME = 180

# Month names of file names, and the business time zone.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def blank(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c) -> Column:
    return F.btrim(blank(c), F.lit(WHITESPACE))


def norm_plan(c) -> Column:
    return F.regexp_replace(F.upper(blank(c)), PLAN_SEPARATORS, "")


def pretty_plan(c) -> Column:
    return F.regexp_replace(F.upper(blank(c)), r"^([A-Z]{2,6})(\d{1,6}[A-Z]{0,3})$", "$1 $2")


def plan_base(c) -> Column:
    return F.regexp_replace(F.upper(strip(c)), r"^(.*\d)([A-Z])$", "$1")


def first_listed(c) -> Column:
    return strip(F.split_part(blank(c), F.lit(","), F.lit(1)))


def emails(c) -> Column:
    return strip(F.replace(blank(c), F.lit(","), F.lit(";")))


def recipients(c) -> Column:
    parts = F.transform(F.split(emails(c), ";"), lambda x: F.btrim(x, F.lit(WHITESPACE)))
    return F.filter(parts, lambda x: x != "")


def name_key(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(blank(c)), "[^A-Z0-9]+", "_"), "^_+|_+$", "")


def sender_domain(address) -> Column:
    """Domain of `x@host` or `Name <x@host>`; blank when there is no usable domain."""
    a = strip(address)
    inner = F.regexp_extract(a, r"(?s)^.*<(.*)>[^>]*$", 1)
    bracketed = F.regexp_extract(a, r"(?s)^.*<(.*)>[^>]*$", 0) != ""
    mail = F.when(bracketed, F.btrim(inner, F.lit(WHITESPACE))).otherwise(a)
    d = F.lower(F.btrim(F.substring_index(mail, "@", -1), F.lit(WHITESPACE)))
    ok = mail.contains("@") & d.contains(".") & ~d.rlike(r"(?U)\s")
    return F.when(ok, d).otherwise("")


def sender_display(name, address) -> Column:
    n, a = strip(name), strip(address)
    return (
        F.when((n != "") & (a != ""), F.concat(n, F.lit(" <"), a, F.lit(">")))
        .when(a != "", a)
        .when(n != "", n)
        .otherwise("(unknown sender)")
    )


def clean_invoice_number(c) -> Column:
    x = F.regexp_replace(F.upper(blank(c)), r"[^A-Z0-9\-]", "")
    return F.when(x.rlike("^-*$"), "").otherwise(x)


def invoice_number(text) -> Column:
    hits = [F.nullif(clean_invoice_number(F.regexp_extract(blank(text), p, 1)), F.lit("")) for p in INVOICE_NUMBER]
    return F.coalesce(*hits, F.lit(""))


def amount_cents(text) -> Column:
    t = blank(text)
    first = [F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in AMOUNT[:-1]]
    last = F.try_element_at(F.regexp_extract_all(t, F.lit(AMOUNT[-1]), F.lit(1)), F.lit(-1))
    raw = F.replace(F.coalesce(*first, last), F.lit(","), F.lit(""))
    return F.replace(raw, F.lit("."), F.lit("")).try_cast("bigint")  # more cents than 64 bits hold are no amount


def leaf_name(c) -> Column:
    return F.substring_index(F.replace(c, F.lit("\\"), F.lit("/")), "/", -1)


def safe_file_name(c, max_length: int = MAX_NAME) -> Column:
    x = F.regexp_replace(leaf_name(blank(c)), INVALID_CHARS, "_")
    x = F.btrim(F.regexp_replace(x, r"(?U)\s+", " "), F.lit(WHITESPACE))
    x = F.regexp_replace(x, r"[. ]+$", "")
    x = F.when(x == "", "file").otherwise(x)
    ext = F.regexp_extract(x, r"(\.[A-Za-z0-9]{1,8})$", 1)
    stem = F.substring(x, F.lit(1), F.length(x) - F.length(ext))
    cut = F.concat(F.substring(stem, F.lit(1), F.lit(max_length) - F.length(ext)), ext)
    return F.when(F.length(x) > max_length, cut).otherwise(x)


def unsafe_component(c) -> Column:
    """Why a (stripped) person name cannot be a folder name; null when it can."""
    x = c
    stem = F.upper(F.substring_index(x, ".", 1))
    return (
        F.when(x == "", "empty")
        .when(x.isin(".", ".."), "dots")
        .when(x.contains("/") | x.contains("\\"), "separator")
        .when(x.rlike("^[A-Za-z]:"), "drive letter")
        .when(x.rlike(INVALID_CHARS), "invalid characters")
        .when(x.rlike("[. ]+$"), "trailing dot or space")
        .when(stem.isin(RESERVED_NAMES), "reserved name")
    )


def is_done_marker(name) -> Column:
    n = F.lower(F.ltrim(blank(name)))
    return n.startswith("processed -") | n.startswith("processed-")


def is_os_junk(name) -> Column:
    n = F.lower(strip(name))
    return n.isin(".ds_store", "thumbs.db", "desktop.ini") | n.startswith("._")


def is_mac_metadata(name) -> Column:
    n = F.replace(blank(name), F.lit("\\"), F.lit("/"))
    return n.startswith("__MACOSX/") | n.contains("/__MACOSX/") | F.substring_index(n, "/", -1).startswith("._")


def name_stem(c) -> Column:
    return F.regexp_replace(c, r"(?<=.)\.[^.]*$", "")


def name_suffix(c) -> Column:
    return F.regexp_extract(c, r".(\.[^.]*)$", 1)


def month_name(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int"))


def check_for_name(c) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(c), INVALID_CHARS, "_"), r"(?U)\s+", "_")


def two_digits(n) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def archive_name(check, month, year, plan) -> Column:
    return safe_file_name(
        F.concat(check_for_name(check), F.lit(" - "), two_digits(month), F.lit(" - "), plan, F.lit(" "), month_name(month), F.lit(" "), year.cast("string"), F.lit(" inv.pdf"))
    )


def summary_name(month, year, plan) -> Column:
    return safe_file_name(F.concat(two_digits(month), F.lit(" - "), plan, F.lit(" "), month_name(month), F.lit(" "), year.cast("string"), F.lit(" inv.pdf")))


# Month words, longest spelling not required (whole-word match, first listed wins).
MONTH_WORDS = {
    "JAN": 1, "JANUARY": 1, "FEB": 2, "FEBRUARY": 2, "MAR": 3, "MARCH": 3, "APR": 4, "APRIL": 4, "MAY": 5, "JUN": 6, "JUNE": 6,
    "JUL": 7, "JULY": 7, "AUG": 8, "AUGUST": 8, "SEP": 9, "SEPT": 9, "SEPTEMBER": 9, "OCT": 10, "OCTOBER": 10, "NOV": 11,
    "NOVEMBER": 11, "DEC": 12, "DECEMBER": 12,
}


def paid_date(raw) -> Column:
    """struct(month, year) of a hand-written date; null when it cannot be read."""
    s = strip(raw)
    up = F.upper(s)
    year1 = F.regexp_extract(up, r"(?U)(?<!\d)(\d{4})(?!\d)", 1).try_cast("int")
    by_month: dict[int, list[str]] = {}
    for w, m in MONTH_WORDS.items():
        by_month.setdefault(m, []).append(w)
    word = F.lit(None).cast("int")
    for m in sorted(by_month, reverse=True):
        word = F.when(up.rlike(rf"(?U)\b(?:{'|'.join(by_month[m])})\b"), m).otherwise(word)
    iso = r"(?U)^\s*(\d{4})[-/](\d{1,2})[-/](\d{1,2})\s*$"
    iso_y, iso_m = F.regexp_extract(s, iso, 1).try_cast("int"), F.regexp_extract(s, iso, 2).try_cast("int")
    num = r"(?U)^\s*(\d{1,2})[-/](\d{1,2})[-/](\d{4})\s*$"
    a, b, y = (F.regexp_extract(s, num, i).try_cast("int") for i in (1, 2, 3))
    month3 = F.when((a > 12) & b.between(1, 12), b).when((b > 12) & a.between(1, 12), a).when(a.between(1, 12) & b.between(1, 12), a)

    def out(m, yr):
        return F.struct(m.alias("month"), yr.alias("year"))

    return (
        F.when(year1.between(1900, 2999) & word.isNotNull(), out(word, year1))
        .when(iso_y.between(1900, 2999) & iso_m.between(1, 12), out(iso_m, iso_y))
        .when(y.between(1900, 2999) & month3.isNotNull(), out(month3, y))
    )


ZONE = "America/Vancouver"


def business_date(ts) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, ZONE))


def business_minute(ts) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, ZONE), "yyyy-MM-dd HH:mm")


def received_text(ts) -> Column:
    return F.upper(F.date_format(F.from_utc_timestamp(ts, ZONE), "MMM dd yyyy"))


def previous_month(day) -> Column:
    return F.add_months(F.trunc(day, "MM"), -1)


def parse_month(c) -> Column:
    """'YYYY-MM' to the first day of that month; null when malformed."""
    return F.when(blank(c).rlike(r"^\d{4}-\d{1,2}$"), F.try_to_date(c, "yyyy-M"))


def month_refusal(target, today) -> Column:
    """Why a month cannot be rolled up: only complete months, at most 24 months back."""
    first = F.trunc(today, "MM")
    back = (F.year(today) - F.year(target)) * 12 + F.month(today) - F.month(target)
    return F.when(target >= first, "current or future").when(back > 24, "more than 24 months back")


def check_key(c) -> Column:
    """Sort key of a check number: (upper prefix, integer, suffix); no digits sorts last.

    The integer is its digits without leading zeros, ordered by their number first, so it may have any length.
    """
    s = strip(c)
    p = r"(?s)^([^\d]*)(\d+)(.*)$"
    has = s.rlike(p)
    digits = F.ltrim(F.regexp_extract(s, p, 2), F.lit("0"))
    return F.when(
        has,
        F.struct(
            F.upper(F.regexp_extract(s, p, 1)).alias("prefix"),
            F.length(digits).alias("n_digits"),
            digits.alias("num"),
            F.regexp_extract(s, p, 3).alias("suffix"),
        ),
    ).otherwise(
        F.struct(F.concat(F.lit("~"), F.upper(s)).alias("prefix"), F.lit(0).alias("n_digits"), F.lit("").alias("num"), s.alias("suffix"))
    )


def plan_from_name(name) -> Column:
    return norm_plan(F.regexp_extract(strip(name), NAME_CODE, 1))


# The archive file name, and prefixes that are never archive output.
ARCHIVE_NAME = (
    r"(?iU)^(.+?)\s*-\s*(0[1-9]|1[0-2])\s*-\s*([A-Z]{2,6}\d{1,6}[A-Z]{0,3})\s+([A-Za-z]+)\s+(\d{4})\s+inv(?:\s*\(\d+\))?\.pdf$"
)
NOT_ARCHIVE = r"(?i)^(processed -|processed-|paid -|paid-|summary -|summary-)"


def parse_archive_name(name) -> Column:
    """struct(check, month, year, plan) of an archive file name; null when it is none."""
    s = strip(name)
    g = [F.regexp_extract(s, ARCHIVE_NAME, i) for i in range(6)]
    month = g[2].try_cast("int")
    ok = (g[0] != "") & ~s.rlike(NOT_ARCHIVE) & (F.lower(g[4]) == F.lower(month_name(F.coalesce(month, F.lit(1)))))
    return F.when(
        ok,
        F.struct(strip(g[1]).alias("check"), month.alias("month"), g[5].try_cast("int").alias("year"), norm_plan(g[3]).alias("plan")),
    )
