"""Pseudonyms: SHA-1 of names and addresses in texts, lists and trailers.

Pseudonymous, not anonymous: hashes are unsalted, the id map holds the originals, and subjects,
code, references and client dates are left as they are. In a text of several lines, an address
alone on a line stays readable unless `strict` is set.
"""

from __future__ import annotations

import re
from hashlib import sha1

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Addresses in text, identities in brackets, and what ends the text before a name.
MAIL = re.compile(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+(?:\.[a-zA-Z]{2,})?")
BRACKETED = re.compile(r"([^<]*?)\s*<([^>]+@[^>]+)>")
LEAD = re.compile(r"(?s)(.*[:,;][ \t]*)?(.*)\Z")
#: One address, or one name and its address in brackets, by itself: the JVM's own functions make its pseudonym.
_NAME, _ADDRESS = r"[!-+\--9=?A-~À-ɏ]", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+"
PLAIN = rf"^(?:{_NAME}+(?: +{_NAME}+)* <{_ADDRESS}>|{_ADDRESS})\z"
TEXT_COLUMNS, LIST_COLUMNS, TRAILER_COLUMN = ("from", "raw_body"), ("to", "cc"), "trailers"


def _digest(s: str) -> str:
    return sha1(s.encode("utf-8", "surrogatepass")).hexdigest()


def _identity(before: str, mail: str, brackets: bool) -> str:
    lead, name = LEAD.match(before).groups()
    if name.strip():
        return f"{lead or ''}{_digest(name.strip())} <{_digest(mail)}>"
    return before + (f"<{_digest(mail)}>" if brackets else _digest(mail))


def _line(line: str, alone_stays: bool) -> str:
    if "@" not in line:
        return line
    line = BRACKETED.sub(lambda m: _identity(m[1], m[2], True), line)
    out, done = [], 0
    for m in MAIL.finditer(line):
        a, b = m.span()
        if line[a - 1 : a] == "<" or line[b : b + 1] == ">":
            continue
        before = line[done:a]
        out.append(before + m[0] if alone_stays and not before.strip() else _identity(before, m[0], False))
        done = b
    return "".join(out) + line[done:]


def pseudonymise_text(text: str, strict: bool = False) -> str:
    lines = text.split("\n")
    return "\n".join([_line(x, len(lines) > 1 and not strict) for x in lines])


def _plain(c: Column) -> Column:
    """Whether a text needs no Python; never NULL."""
    return c.isNull() | ~c.contains("@") | c.rlike(PLAIN)


def _plain_pseudonym(c: Column) -> Column:
    """pseudonymise_text of what _plain accepts; NULL stays NULL."""
    mail = F.substring_index(F.substring_index(c, "<", -1), ">", 1)
    both = F.concat(F.sha1(F.rtrim(F.substring_index(c, "<", 1))), F.lit(" <"), F.sha1(mail), F.lit(">"))
    return F.when(~c.contains("@"), c).when(c.contains("<"), both).otherwise(F.sha1(c))


def pseudonymise(c: Column, strict: bool = False) -> Column:
    """Texts without an @ and plain identities never leave the JVM."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else pseudonymise_text(t, strict))

    return F.coalesce(run(F.when(~_plain(c), c)), _plain_pseudonym(c))


def pseudonymise_list(c: Column, strict: bool = False) -> Column:
    """Element by element; a NULL list stays NULL, a NULL element becomes empty. Lists of plain identities never leave the JVM."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda xs: None if xs is None else [pseudonymise_text(x or "", strict) for x in xs])

    return F.coalesce(run(F.when(F.exists(c, lambda x: ~_plain(x)), c)), F.transform(c, lambda x: F.coalesce(_plain_pseudonym(x), F.lit(""))))


def pseudonymise_trailers(c: Column, strict: bool = False) -> Column:
    """Identifications only; other fields stay; NULL becomes []."""
    names = pseudonymise_list(F.transform(c, lambda t: t["identification"]), strict)
    return F.coalesce(F.zip_with(c, names, lambda t, n: t.withField("identification", n)), F.expr("array()"))


def pseudonymise_frame(df: DataFrame, strict: bool = False) -> DataFrame:
    """Identity columns that are present, by their types; other columns are untouched."""
    kinds = dict(df.dtypes)
    made = {c: pseudonymise(F.col(f"`{c}`"), strict) for c in TEXT_COLUMNS if kinds.get(c) == "string"}
    made |= {c: pseudonymise_list(F.col(f"`{c}`"), strict) for c in LIST_COLUMNS if kinds.get(c) == "array<string>"}
    if TRAILER_COLUMN in kinds:
        made[TRAILER_COLUMN] = pseudonymise_trailers(F.col(TRAILER_COLUMN), strict)
    return df.withColumns(made) if made else df


def id_map(df: DataFrame) -> DataFrame:
    """One row per e-mail: original and pseudonymous sender."""
    keep = ["list"] if "list" in df.columns else []
    return df.select(*keep, F.col("`from`").alias("__original_from"), pseudonymise(F.col("`from`")).alias("from"))
