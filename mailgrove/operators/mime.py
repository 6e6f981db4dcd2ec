"""The one step that needs Python: raw message bytes to headers, body and dates.

Never raises: what can't be decoded gives an error text. Headers are split leniently, so that a
malformed line doesn't end the header block; bodies are decoded by the standard library.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime
from email import message_from_bytes, policy
from email.header import decode_header

import pandas as pd

from mailgrove.functions.addresses import LOCAL, HOST, is_obfuscated, join_split_names, normalize, repair_raw_header
from mailgrove.functions.dates import parse_micros

SCHEMA = (
    "`from` string, `to` array<string>, cc array<string>, subject string, date_options array<bigint>, client_date array<string>, message_id string, "
    "in_reply_to string, `references` array<string>, x_mailing_list string, raw_body string, error string"
)
# A From line inside a message, plain, with (a), with " at ".
BODY_FROM = [
    re.compile(rf"(?im)^From:\s*([^<\n]*?)?\s*<({LOCAL})@({HOST})>"),
    re.compile(rf"(?im)^From:\s*([^<\n]*?)?\s*<({LOCAL})\s*\(a\)\s*({HOST})>"),
    re.compile(rf"(?im)^From:\s*([^<\n]*?)?\s*<?({LOCAL})\s+at\s+({HOST})>?"),
]
_NAME = re.compile(rb"^([!-9;-~]+):[ \t]*(.*)$", re.S)


def split_headers(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """([(lower-case name, raw value)], what follows the first empty line); lines without a colon are skipped."""
    data = data.replace(b"\r\n", b"\n")
    head, _, rest = data.partition(b"\n\n")
    if data.startswith(b"\n"):
        head, rest = b"", data[1:]
    lines: list[bytes] = []
    for line in head.split(b"\n"):
        if line[:1] in (b" ", b"\t") and lines:
            lines[-1] += b"\n" + line
        elif _NAME.match(line):
            lines.append(line)
    return [(m[1].decode("ascii").lower(), m[2].decode("utf-8", "replace")) for m in map(_NAME.match, lines)], rest


def decode_value(raw: str) -> str:
    """Unfolded and RFC 2047-decoded."""
    flat = re.sub(r"\s*\n\s+", " ", raw).strip()
    if "=?" not in flat:
        return flat
    try:
        parts = [b.decode(c or "ascii", "replace") if isinstance(b, bytes) else b for b, c in decode_header(flat)]
    except (LookupError, ValueError):
        return flat
    return "".join(parts).strip()


def body_of(headers: list[tuple[str, str]], rest: bytes) -> str:
    """Text parts joined by line ends, with inline HTML of a mixed message; HTML parts when there is no text."""
    keep = [f"{n}: {' '.join(v.split())}".encode("utf-8", "replace") for n, v in headers if n.startswith("content-") or n == "mime-version"]
    message = message_from_bytes(b"\n".join(keep) + b"\n\n" + rest, policy=policy.compat32)
    texts, pages = [], []

    def walk(part, mixed):
        if part.is_multipart():
            for p in part.get_payload():
                walk(p, part.get_content_subtype() in ("mixed", "related") if part.get_content_maintype() == "multipart" else mixed)
            return
        kind = part.get_content_type()
        if part.get_content_disposition() == "attachment" or not kind.startswith("text/"):
            return
        data = part.get_payload(decode=True) or b""
        try:
            text = data.decode(part.get_content_charset() or "utf-8", "replace")
        except LookupError:
            text = data.decode("utf-8", "replace")
        if kind == "text/html":
            pages.append(text)
            if mixed and texts:
                texts.append(text)
        else:
            texts.append(text)

    walk(message, False)
    chosen = texts if any(t.strip() for t in texts) else pages
    return "\n".join(chosen).replace("\r\n", "\n")


def identities(raw: str) -> list[str]:
    text = decode_value(raw)
    return repair_raw_header(text) if is_obfuscated(text) else join_split_names(re.split(r',(?=(?:[^"]*"[^"]*")*[^"]*$)(?![^<]*>)', text.replace("\t", " ")))


def _clean(x: str) -> str:
    return x.replace('"', "").strip()


def leaked_senders(text: str) -> list[str]:
    return [f"{(m[1] or '').strip()} <{m[2]}@{m[3]}>".removeprefix(" <").removesuffix(">" if not (m[1] or "").strip() else "") for p in BODY_FROM for m in p.finditer(text)]


def _score(x: str) -> tuple:
    return (bool(re.match(r"\s*[^<\s][^<]*<", x)), bool(re.search(rf"{LOCAL}@{HOST}", x)), 0 if re.search(r"(?i)\(a\)", x) else 1 if re.search(r"(?i)\s+at\s+", x) else 2)


def sender(values: list[str], whole: str) -> str:
    """The best of the From headers; addresses leaked into the message help out when none has a name."""
    options = [_clean(decode_value(v)) for v in values]
    if not any(_score(o)[0] for o in options):
        options += leaked_senders(whole)
    return normalize(max(options, key=_score)) if options else ""  # max keeps the first of equals


def parse_message(data: bytes, now: datetime) -> dict:
    out = {"from": "", "to": None, "cc": None, "subject": "", "date_options": [], "client_date": None, "message_id": "", "in_reply_to": None, "references": None, "x_mailing_list": None, "raw_body": "", "error": None}
    if not data.strip():
        return out | {"error": "DecodeError: empty message"}
    headers, rest = split_headers(data)
    if not headers:
        return out | {"error": "DecodeError: no headers"}
    every: dict[str, list[str]] = {}
    for name, raw in headers:
        every.setdefault(name, []).append(raw)
    angle = lambda v: [x.strip() for x in re.findall(r"<([^>]*)>", v)] or v.split()
    for key, name in (("subject", "subject"), ("x_mailing_list", "x-mailing-list")):
        if name in every:
            out[key] = decode_value(every[name][-1])
    for key, name in (("message_id", "message-id"), ("in_reply_to", "in-reply-to")):
        if name in every:
            out[key] = " ".join(angle(decode_value(every[name][-1])))
    for key in ("to", "cc"):
        found = [_clean(x) for raw in every.get(key, []) for x in identities(raw)]
        out[key] = [x for x in found if x] or None
    out["references"] = [x for raw in every.get("references", []) for x in angle(decode_value(raw))] or None
    out["client_date"] = [decode_value(x) for x in every.get("date", [])] or None
    dates = [decode_value(x) for n in ("date", "received", "x-received") for x in every.get(n, [])]
    out["date_options"] = [m for m in (parse_micros(d.rpartition(";")[2] or d, now) for d in dates) if m is not None]
    out["from"] = sender(every.get("from", []), data.decode("utf-8", "replace"))
    out["raw_body"] = body_of(headers, rest)
    return out


def parse_series(content: pd.Series, now_micros: int) -> pd.DataFrame:
    now = datetime.fromtimestamp(now_micros / 1e6, UTC)
    rows = []
    for data in content:
        try:
            rows.append(parse_message(bytes(data or b""), now))
        except Exception as e:  # any message may be broken in its own way; it becomes an error row
            rows.append(parse_message(b"", now) | {"error": f"{type(e).__name__}: {e}"})
    return pd.DataFrame(rows, columns=[c.split("`")[1] if "`" in c else c.split()[0] for c in SCHEMA.split(", ")])
