"""String cleaning and parsing as column expressions.

All but the Unicode fold are JVM built-ins (regexp_replace, try_cast, ...).
The NFKD fold (F5) has no built-in in Spark 4.1, so it is an Arrow-batched
pandas UDF over one column, used only to build ids.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Trim all leading / trailing whitespace (not only spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def clean_number(col: Column | str, allow_float: bool = True) -> Column:
    """strip, drop ',' and '%'; empty or unparsable -> NULL; integer mode truncates toward zero."""
    s = F.regexp_replace(strip_ws(col), "[,%]", "")
    num = s.try_cast("double")
    if allow_float:
        return num
    return num.try_cast("bigint")


def signed_number(col: Column | str) -> Column:
    """'+x' -> x, '-x' -> -x, but a negative zero (or unparsable) -> NULL."""
    c = _c(col)
    rest = clean_number(F.substring(c, 2, 1 << 30))
    return (
        F.when(c.startswith("+"), rest)
        .when(c.startswith("-"), -F.nullif(rest, F.lit(0.0)))
        .otherwise(clean_number(c))
    )


def parse_currency(col: Column | str) -> Column:
    """'€700k' -> 0.7, '€1,5m' -> 1.5, '€500.000' -> 0.5 (million); bad or empty -> NULL.

    'k' and bare amounts use '.' as thousands separator and ',' as decimal
    point; 'm' amounts read ',' as the decimal point.
    """
    s = F.lower(strip_ws(F.regexp_replace(_c(col), "€", "")))
    body = F.substring(s, 1, F.greatest(F.length(s) - 1, F.lit(0)))

    def euro_decimal(x: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(x, r"\.", ""), ",", ".").try_cast("double")

    return (
        F.when(s == "", F.lit(None).cast("double"))
        .when(s.endswith("k"), euro_decimal(body) / 1000)
        .when(s.endswith("m"), F.regexp_replace(body, ",", ".").try_cast("double"))
        .otherwise(euro_decimal(s) / 1_000_000)
    )


def parse_height_m(col: Column | str) -> Column:
    """'1,83 m' -> 183 (truncated product, as int)."""
    num = F.regexp_replace(F.regexp_extract(_c(col), r"([\d,]+)\s*m", 1), ",", ".")
    return (num.try_cast("double") * 100).try_cast("int")


def parse_height_cm(col: Column | str) -> Column:
    """'183cm' -> 183.0."""
    return strip_ws(F.regexp_replace(_c(col), "cm", "")).try_cast("double")


@F.pandas_udf(StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """F5 (fold part): NFKD decomposition then drop every non-ASCII code point."""
    return s.map(
        lambda v: None if v is None else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
    )


def slugify(col: Column | str) -> Column:
    """fold to ASCII, lower, drop [^\\w\\s-], collapse runs of '-' / whitespace to '-', trim '-'."""
    s = F.lower(ascii_fold(_c(col)))
    s = F.regexp_replace(s, r"[^\w\s-]", "")
    s = F.regexp_replace(s, r"[-\s]+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def stable_id(name: Column | str, dob: Column | str | None = None, nationality: Column | str | None = None) -> Column:
    """slug(name) + '-' + first 6 hex digits of md5('name:dob:nationality'), NULLs as ''."""
    def part(x):
        return F.lit("") if x is None else F.coalesce(_c(x).cast("string"), F.lit(""))

    digest = F.md5(F.concat_ws(":", part(name), part(dob), part(nationality)))
    return F.concat(slugify(name), F.lit("-"), F.substring(digest, 1, 6))


def age_asof(dob: Column | str, asof: Column | str) -> Column:
    """whole years between dates; minus one if (month, day) of as-of is before the birthday."""
    d, t = F.to_date(_c(dob)), F.to_date(_c(asof) if not isinstance(asof, str) else F.lit(asof))
    before = (F.date_format(t, "MMdd") < F.date_format(d, "MMdd")).cast("int")
    return F.year(t) - F.year(d) - before


def regex_capture(col: Column | str, pattern: str, group: int = 1) -> Column:
    """F8: first capture of ``pattern`` after replacing non-breaking spaces; no match -> NULL."""
    txt = F.regexp_replace(_c(col), "\u00a0", " ")
    return F.nullif(F.regexp_extract(txt, pattern, group), F.lit(""))


# Named character references decoded (``&amp;`` is decoded last).
NAMED_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&euro;", "€")]


def decode_entities(col: Column | str) -> Column:
    """Character references of HTML text decoded once: named ones, decimal and hexadecimal numbers."""
    c = _c(col)
    for name, value in NAMED_REFERENCES:
        c = F.replace(c, F.lit(name), F.lit(value))
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)"), F.lit(1)))

    def decoded(text: Column, ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"&#[xX]?([0-9a-fA-F]+);", 1)
        code = F.when(F.lower(ref).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        valid = (code > 0) & (code != 38) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.replace(text, ref, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))).otherwise(text)

    c = F.aggregate(refs, c, decoded)
    return F.regexp_replace(c, r"&(?:amp|#0{0,4}38|#[xX]0{0,4}26);", "&")


def label_from_name(col: Column | str) -> Column:
    """'shots_per90' -> 'Shots Per90'."""
    return F.initcap(F.regexp_replace(_c(col), "_", " "))


def file_safe(col: Column | str) -> Column:
    """spaces -> '_'."""
    return F.regexp_replace(_c(col), " ", "_")


def absolute_url(base: str, col: Column | str) -> Column:
    """prefix relative hrefs with the site root."""
    c = _c(col)
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(base.rstrip("/")), c))


def truncate(col: Column | str, n: int = 30) -> Column:
    """F11."""
    return F.substring(_c(col), 1, n)
