"""Identifiers, ranges, globs and write modes."""

from __future__ import annotations

import re
from fnmatch import fnmatchcase

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_ID = r"^(\d{10})-e([^-]+)-([0-9a-f]+)$"


def format_email_id(n: Column, epoch: Column, sha: Column) -> Column:
    return F.format_string("%010d-e%s-%s", n.cast("long"), epoch.cast("string"), sha)


def parse_email_id(c: Column) -> Column:
    """struct<position, epoch, sha>; NULL when malformed."""
    part = lambda i: F.regexp_extract(c, EMAIL_ID, i)
    return F.when(c.rlike(EMAIL_ID), F.struct(part(1).cast("long").alias("position"), part(2).alias("epoch"), part(3).alias("sha")))


def message_id_of(content: Column) -> Column:
    """The trimmed value of the first message-id line, NULL without one."""
    pattern = r"(?imd)^message-id:(.*)$"
    return F.when(content.rlike(pattern), F.trim(F.regexp_extract(content, pattern, 1)))


def parse_ranges(text: str) -> list[tuple[int, int]]:
    """`1,3-5,10` -> inclusive intervals; ValueError for empty parts, bad numbers, and descending ranges."""
    out = []
    for part in text.split(","):
        m = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", part)
        if not m:
            raise ValueError(f"not a range: {part!r}")
        low, high = int(m[1]), int(m[2] or m[1])
        if high < low:
            raise ValueError(f"descending range: {part!r}")
        out.append((low, high))
    return out


def in_ranges(c: Column, text: str) -> Column:
    """A predicate that pushes down; ranges are never expanded."""
    cond = F.lit(False)
    for low, high in parse_ranges(text):
        cond = cond | (c == low if low == high else c.between(low, high))
    return cond


def expand_globs(patterns: list[str], names: list[str]) -> tuple[list[str], list[str]]:
    """(names matched, without repeats, in order of the first pattern that takes them; patterns that took none)."""
    taken: list[str] = []
    idle = []
    for p in patterns:
        hits = [n for n in names if (fnmatchcase(n, p) if any(ch in p for ch in "*?") else n == p) and n not in taken]
        taken += hits
        if not hits:
            idle.append(p)
    return taken, idle


def parse_write_mode(text: str, default: int = 10_000) -> tuple[str, int | None]:
    """('raw', None) or ('parquet', mails a file)."""
    t = text.strip().lower()
    if t in ("raw", "raw_email", "rawemail"):
        return "raw", None
    if m := re.fullmatch(r"parquet\D*(\d*)", t):
        return "parquet", int(m[1]) if m[1] else default
    raise ValueError(f"unknown write mode: {text!r}")
