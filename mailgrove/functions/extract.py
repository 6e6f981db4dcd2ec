"""Trailers and patches of a body, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailgrove.functions.addresses import normalize_address, trim

# Trailer and patch patterns. Lines end at \n only, hence the d flag.
WRAPPED_REFERENCE = r"(?md)^(\S+:\s+[\da-f]+\s+\([^)]+)\n([^\n]+\))"
WRAPPED_MAIL = r"(?md)^(\S+:\s+[^<]+)\n(<[^>]+>)$"
TRAILER = r"(?md)^\s*([a-zA-Z\-]+-by):\s*([^<\n]+?)\s*<([^>\n]+)>"
#: The same trailers as a whole, without a search for where its name ends.
WHOLE = r"(?md)^\s*[a-zA-Z\-]+-by:\s*[^<\n]++\s*+<[^>\n]+>"
DIFF, SEPARATOR = r"(?imd)^diff --git ", r"(?md)(?=^---\s*$)"
SIGNATURE = "\n-- \n"


def found(body: Column) -> Column:
    """array<string> of the whole trailers, in order; NULL for NULL."""
    text = F.substring_index(body, SIGNATURE, 1)
    # a wrapped reference has a bracket, a wrapped address begins a line
    joined = F.regexp_replace(F.regexp_replace(text, WRAPPED_REFERENCE, "$1 $2"), WRAPPED_MAIL, "$1 $2")
    return F.regexp_extract_all(F.when(text.contains("(") | text.contains("\n<"), joined).otherwise(text), F.lit(WHOLE), 0)


def attribution(whole: Column) -> Column:
    """What stands before the first colon of a trailer found."""
    return trim(F.substring_index(whole, ":", 1))


def named_mail(whole: Column) -> Column:
    """`Name <mail>` of a trailer found, not yet normalised: a name holds no <, a mail no >."""
    before = F.substring_index(whole, "<", 1)
    name = F.substring(before, F.length(F.substring_index(whole, ":", 1)) + 2, F.length(before))
    mail = F.substring_index(F.substring(whole, F.length(before) + 2, F.length(whole)), ">", 1)
    return F.concat(trim(name), F.lit(" <"), trim(mail), F.lit(">"))


def trailers(body: Column) -> Column:
    """array<struct<attribution, identification>>, in order; [] without any or for NULL."""
    parts = F.transform(found(body), lambda t: F.struct(attribution(t).alias("attribution"), named_mail(t).alias("identification")))
    # in two steps, so that an address is put together once and not for each of its tests
    made = F.transform(parts, lambda t: F.struct(t["attribution"].alias("attribution"), normalize_address(t["identification"]).alias("identification")))
    return F.coalesce(made, F.array().cast("array<struct<attribution:string,identification:string>>"))


def patches(body: Column) -> Column:
    """array<string> of the sections between --- lines that hold a diff, trimmed; NULL without any."""
    found = F.filter(F.transform(F.split(body, SEPARATOR, -1), trim), lambda s: s.rlike(DIFF))
    return F.when(body.rlike(DIFF) & (F.size(found) > 0), found)
