"""Fixed schemas of raw, parsed, lineage and id-map data."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType([T.StructField("email_id", T.StringType(), False), T.StructField("content", T.StringType(), False)])
TRAILER = T.StructType([T.StructField("attribution", T.StringType(), False), T.StructField("identification", T.StringType(), False)])
_TEXTS = T.ArrayType(T.StringType())
#: Absent values: NULL for to, cc, client_date, references, code, date, in_reply_to, x_mailing_list; [] for trailers; "" otherwise.
EMAIL = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", _TEXTS),
        T.StructField("cc", _TEXTS),
        T.StructField("subject", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("client_date", _TEXTS),
        T.StructField("message_id", T.StringType()),
        T.StructField("in_reply_to", T.StringType()),
        T.StructField("references", _TEXTS),
        T.StructField("x_mailing_list", T.StringType()),
        T.StructField("trailers", T.ArrayType(TRAILER), False),
        T.StructField("code", _TEXTS),
        T.StructField("raw_body", T.StringType()),
        T.StructField("__file_name", T.StringType()),
    ]
)
LINEAGE_KEYS = ["email_index", "list_name", "source_type", "write_mode", "archive_timestamp", "archiver_build_info"]
ID_MAP = T.StructType([T.StructField("__original_from", T.StringType()), T.StructField("from", T.StringType())])
