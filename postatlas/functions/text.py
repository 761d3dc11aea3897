"""Text functions, all Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(x: Column) -> Column:
    """Null where a string is null or empty."""
    return F.nullif(x, F.lit(""))


def either(a: Column, b: Column) -> Column:
    """``a`` unless it is null or empty, else ``b``."""
    return F.coalesce(truthy(a), b)


#: White space as a regular expression class has it in JSON's home language: U+FEFF belongs to it, U+0085 does not.
WHITE = r"\t-\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"


def trim_unicode(x: Column) -> Column:
    return F.regexp_replace(x, f"^[{WHITE}]+|[{WHITE}]+$", "")


def html_to_text(html: Column) -> Column:
    """Line breaks for <br> and </p>, no tags, five entities decoded (&amp; first), single line feeds, trimmed."""
    x = F.coalesce(html, F.lit(""))
    x = F.regexp_replace(x, f"(?i)<br[{WHITE}]*/?>", "\n")
    x = F.regexp_replace(x, r"(?i)</p>", "\n")
    x = F.regexp_replace(x, r"<[^>]+>", "")
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return trim_unicode(F.regexp_replace(x, r"\n{2,}", "\n"))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"#([^{WHITE}#]+)"), 1)


def haystack(text: Column, tags: Column, location: Column) -> Column:
    """The non-empty ones of text, tags and profile location, joined by a space."""
    parts = F.array(text, F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " "), location)
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), " ")


def escape_html(x: Column) -> Column:
    x = F.coalesce(x, F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(char), F.lit(entity))
    return x


def guard_script(x: Column) -> Column:
    """Keeps a closing script tag inside JSON from ending its element."""
    return F.regexp_replace(x, r"(?i)</script>", r"<\\/script>")


def encode_uri(x: Column) -> Column:
    """Percent-encoding in which a space is %20 and !'()*~ stay."""
    x = F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))
    for code, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        x = F.replace(x, F.lit(code), F.lit(char))
    return x


def image_number(path: Column) -> Column:
    """The number in an image's name, without leading zeros; null for other names."""
    return F.try_to_number(truthy(F.regexp_extract(path, r"ramen-(\d+)", 1)), F.lit("999999999")).cast("long").cast("string")


def config_list(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, ","), lambda s: trim_unicode(s)), lambda s: s != "")


# Labels and classes of confidence, labels of methods.
CONFIDENCE_LABELS = {"high": "ジオタグ", "medium": "地名(市区)", "low": "地名(都道府県)"}


def confidence_label(x: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in CONFIDENCE_LABELS.items():
        out = F.when(x == k, F.lit(v)).otherwise(out)
    return out


def confidence_class(x: Column) -> Column:
    return F.when(x.isin(*CONFIDENCE_LABELS), F.concat(F.lit("c-"), x))


def method_label(x: Column) -> Column:
    return F.when(x == "geotag", "ジオタグ").otherwise("本文の地名")


def to_fixed(x: Column, digits: int) -> Column:
    """Rounded to a number of decimals by the exact binary value, halves away from zero.

    The value is split in two parts whose products with the power of ten are
    exact, so that a value just below a half is not rounded up.
    """
    power = float(10**digits)
    a = F.abs(x)
    c = a * F.lit(134217729.0)
    high = c - (c - a)
    k = F.floor(a * power).cast("double")
    above = (high * power - (k + 0.5)) + (a - high) * power >= 0
    return F.signum(x) * (k + F.when(above, 1.0).otherwise(0.0)) / power
