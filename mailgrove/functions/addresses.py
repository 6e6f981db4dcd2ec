"""Address normalisation as Columns, and the list repairs that need state as plain Python."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide what is an address.
LOCAL, HOST = r"[a-zA-Z0-9._%+-]+", r"[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PLAIN = rf"^(?U:\s*)([^<]*?)(?U:\s*)<?({LOCAL}@{HOST})>?(?U:\s*)\z"
WITH_A = rf"^(?U:\s*)([^<]*?)(?U:\s*)<?({LOCAL})(?U:\s*)\(a\)(?U:\s*)({HOST})>?(?U:\s*)\z"
WITH_AT = rf"(?i)^(?U:\s*)([^<]*?)(?U:\s*)<?({LOCAL})(?U:\s+)at(?U:\s+)({HOST})>?(?U:\s*)\z"
#: What needs no repair.
SIMPLE = rf"^[^<\s](?:[^<]*[^<\s])? <{LOCAL}@{HOST}>\z"
#: Inside brackets without an @: local part up to the last character that can't be in a host's first label.
STRIPPED = r"^([^<]*)<([^@>]*[^A-Za-z0-9@>-])([A-Za-z0-9-]+\.[A-Za-z]{2,4})>(?U:\s*)\z"


#: Unicode's white space.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.btrim(c, F.lit(WHITE))


def named(name: Column, mail: Column) -> Column:
    name = trim(name)
    return F.when(name == "", mail).otherwise(F.concat(name, F.lit(" <"), mail, F.lit(">")))


def normalize_address(c: Column) -> Column:
    """`Name <mail>` or `mail`, repairing `(a)`, ` at ` and a lost @; else unchanged."""
    pair = lambda p: named(F.regexp_extract(c, p, 1), F.concat(F.regexp_extract(c, p, 2), F.lit("@"), F.regexp_extract(c, p, 3)))
    return (
        # cheap tests first: most addresses are plain
        F.when(c.rlike(SIMPLE), c)
        .when(c.contains("(a)") & c.rlike(WITH_A), pair(WITH_A))
        .when(F.lower(c).contains("at") & ~c.contains("@") & c.rlike(WITH_AT), pair(WITH_AT))
        .when(~c.contains("@") & c.rlike(STRIPPED), pair(STRIPPED))
        .when(c.rlike(PLAIN), named(F.regexp_extract(c, PLAIN, 1), F.regexp_extract(c, PLAIN, 2)))
        .otherwise(c)
    )


def score_address(c: Column) -> Column:
    """Orders candidates: has a name, is standard, how it is obfuscated (2 none, 1 ` at `, 0 `(a)`)."""
    return F.struct(
        c.rlike(r"^\s*[^<\s][^<]*<").alias("has_name"),
        c.rlike(rf"{LOCAL}@{HOST}").alias("is_standard"),
        F.when(c.rlike(r"(?i)\(a\)"), 0).when(c.rlike(r"(?i)\s+at\s+"), 1).otherwise(2).alias("clarity"),
    )


def best_address(values: Column) -> Column:
    """The best-scored element (the first of equals), normalised."""
    scored = F.transform(values, lambda x, i: F.struct(score_address(x).alias("s"), (-i).alias("i"), x.alias("v")))
    return normalize_address(F.array_max(scored)["v"])


def strip_comment_artifacts(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?i)\s*\(a\)\s*", " "))


# The same rules for the parsing UDF, where lists are repaired with state.
_PY = [re.compile(p.replace("(?U:", "(?:"), 0) for p in (WITH_A.replace(r"\z", r"\Z"), WITH_AT.replace(r"\z", r"\Z"), STRIPPED.replace(r"\z", r"\Z"), PLAIN.replace(r"\z", r"\Z"))]


def normalize(value: str) -> str:
    for i, pattern in enumerate(_PY):
        if m := pattern.match(value):
            mail = m[2] if i == 3 else f"{m[2]}@{m[3]}"
            name = m[1].strip()
            return f"{name} <{mail}>" if name else mail
    return value


def join_split_names(parts: list[str]) -> list[str]:
    """A part without an address belongs before the next part that has one; commas go from the result."""
    out, waiting = [], []
    for part in filter(None, (p.strip() for p in parts)):
        if "@" not in part:
            waiting.append(part)
            continue
        out.append(normalize(" ".join([*waiting, part])).replace(",", ""))
        waiting = []
    return out + [" ".join(waiting).replace(",", "")] * bool(waiting)


def repair_raw_header(raw: str) -> list[str]:
    """Identities of a raw To or Cc header with obfuscated addresses."""
    body = re.sub(r"^[A-Za-z-]+:", "", raw, count=1)
    body = re.sub(r"(?i)\s*\(a\)\s*", "@", body)
    body = re.sub(r"(?i)(\S)\s+at\s+(?=[\w.-]+\.\w{2,})", r"\1@", re.sub(r"\s+", " ", body))
    return join_split_names(re.split(r",(?![^<]*>)", body))


def is_obfuscated(raw: str) -> bool:
    return "(a)" in raw or "(A)" in raw or " at " in raw
