"""Scalar functions: keys, postal codes, names, rates, URLs, paths and hashed names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an address is made of, by the generic grammar of URIs: unreserved characters, delimiters but for brackets and the
# apostrophe, which more often close a quotation than belong to an address, and percent signs.
_UNRESERVED, _DELIMITERS = r"A-Za-z0-9\-._~", r":/?#@!$&()*+,;="
#: An address in a text: it starts with http, https or www.
URL = rf"(?i)(?:https?://|www\.)[{_UNRESERVED}{_DELIMITERS}%]+"


def blank_to_null(c: Column) -> Column:
    """Trims; null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def missing_to_null(c: Column) -> Column:
    """Null for blank text and for the spellings of a missing value in exported tables."""
    return F.when(~F.trim(c).isin("", "nan", "None"), c)


def canonical_key(c: Column) -> Column:
    """One spelling for a provider key: 7, 7.0 and '7' are the same; anything that is not a number stays as it is."""
    text = F.trim(c.cast("string"))
    whole = F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")
    short = F.regexp_replace(whole, r"^(-?\d+\.\d*?)0+$", "$1")
    number = text.try_cast("decimal(38,10)")
    plain = F.regexp_replace(F.regexp_replace(number.cast("string"), r"0+$", ""), r"\.$", "")
    return F.when(text.rlike(r"^-?\d+(\.\d+)?[eE][+-]?\d+$"), plain).otherwise(short)


def zip5(c: Column) -> Column:
    """The first five digits of a postal code."""
    return F.left(F.regexp_replace(c.cast("string"), "[^0-9]", ""), F.lit(5))


def zip_padded(c: Column) -> Column:
    return F.lpad(c.cast("string"), 5, "0")


def rate(c: Column) -> Column:
    """A price as a number, thousands separators aside; null if it is none."""
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit("")).try_cast("double")


def digit_runs(c: Column) -> Column:
    """All runs of digits, as for lists of provider identifiers written into a cell."""
    return F.coalesce(F.regexp_extract_all(c.cast("string"), F.lit(r"(\d+)"), F.lit(1)), F.array().cast("array<string>"))


def first_filled(*cs: Column) -> Column:
    """The first value that is not blank, trimmed; empty text if all are."""
    return F.coalesce(*(blank_to_null(c) for c in cs), F.lit(""))


def shortened(c: Column, size: int = 90) -> Column:
    return F.concat(F.rtrim(F.left(c, F.lit(size))), F.when(F.length(c) > size, "...").otherwise(""))


def joined(sep: str, *cs: Column) -> Column:
    """The values that are not blank with a separator between them."""
    return F.concat_ws(sep, *(blank_to_null(c) for c in cs))


def provider_name(organization: Column, first: Column, middle: Column, last: Column) -> Column:
    """The organization, else the person's names; empty text if there is neither."""
    return F.when(blank_to_null(organization).isNotNull(), organization).otherwise(joined(" ", first, middle, last))


def provider_location(line1: Column, line2: Column, city: Column, state: Column, postal: Column, phone: Column) -> Column:
    """Address, five digits of the postal code and telephone in one line."""
    return F.concat_ws(", ", blank_to_null(line1), blank_to_null(line2), blank_to_null(city), blank_to_null(state), F.left(blank_to_null(postal), F.lit(5)), F.concat(F.lit("Tel: "), blank_to_null(phone)))


def has_url(c: Column) -> Column:
    return F.coalesce(c.cast("string").rlike(URL), F.lit(False))


def urls(c: Column) -> Column:
    """All addresses in a text, each once; www. becomes https://www."""
    found = F.coalesce(F.regexp_extract_all(c.cast("string"), F.lit(URL), F.lit(0)), F.array().cast("array<string>"))
    return F.array_distinct(F.transform(found, lambda u: F.when(u.startswith("www."), F.concat(F.lit("https://"), u)).otherwise(u)))


def first_url(c: Column) -> Column:
    return F.get(urls(c), F.lit(0))


def url_tail(c: Column) -> Column:
    """The last segment of an address, without its query."""
    return F.element_at(F.split(F.split_part(c, F.lit("?"), F.lit(1)), "/"), -1)


def file_of_url(c: Column) -> Column:
    """The file name under which the content of an address is kept."""
    return F.concat(F.lit("url_"), F.left(F.md5(c), F.lit(16)), F.lit(".json"))


def original_name(c: Column) -> Column:
    """A file name without the number of a split part (four or five digits)."""
    return F.regexp_replace(c, r"_part\d{4,5}(\.json(\.gz)?)$", "$1")


def without_prefixes(c: Column, *prefixes: str) -> Column:
    """A file name without the marks of finished steps at its start."""
    marks = "|".join(map(re.escape, prefixes or ("_ingested_", "_analyzed_")))
    return F.regexp_replace(c, f"^(?:{marks})+", "")


def normal_path(c: Column) -> Column:
    """A path with its item numbers left out: a[3].b becomes a[].b."""
    return F.regexp_replace(c, r"\[\d+\]", "[]")


def top_key(c: Column) -> Column:
    return F.regexp_extract(c, r"^[^.\[]+", 0)


def group_name(c: Column) -> Column:
    """The name of the group that a signature or schema text stands for."""
    return F.concat(F.lit("group_"), F.left(F.sha2(c.cast("string").cast("binary"), 256), F.lit(12)))


def hash_bucket(c: Column, n: int) -> Column:
    """A partition number; never negative."""
    return F.pmod(F.hash(c), F.lit(n))


def run_id(now: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if now is None else now, "'run_'yyyyMMdd_HHmmss")


def list_items(c: Column) -> Column:
    """A comma-separated list as trimmed items that are not empty; null if there are none."""
    items = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def json_field(c: Column, name: str, kind: str = "string") -> Column:
    """One field of a JSON text; null where the text is none or lacks it."""
    return F.from_json(c, f"`{name}` {kind}")[name]


def identifier(name: str, taken: set[str] | None = None) -> str:
    """A column name from a header: lower case, words joined by _, not starting with a digit; _2, _3 if it is taken."""
    base = re.sub(r"[^0-9a-z]+", "_", (name or "").strip().lower()).strip("_") or "col"
    base = f"col_{base}" if base[0].isdigit() else base
    out, k = base, 2
    while taken is not None and out in taken:
        out, k = f"{base}_{k}", k + 1
    if taken is not None:
        taken.add(out)
    return out
