"""Column expressions for common-log-format lines.

Fixed values: the patterns below reproduce the original extraction rules
exactly, including regex greed (the request is the text between the *last*
two double quotes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extraction patterns, group 1 is the field.
HOST_PATTERN = r"^(.*) - -.*"
TIMESTAMP_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'
# Organisation = the last three labels (".ac.uk", ".ac.jp") or the last two
# (".edu") of the host name.
ORG_PATTERN_3 = r"([^\.]+\.\w+\.\w+$)"
ORG_PATTERN_2 = r"([^\.]+\.\w+$)"
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"


def parse_columns(value: str | Column = "value") -> list[Column]:
    """host, timestamp, request, status, bytes from one raw log line.

    status and bytes are the second-last and last space-separated tokens;
    a missing token (one-token line) or a non-number ('-') gives null
    instead of failing under ANSI mode.
    """
    v = F.col(value) if isinstance(value, str) else value
    tokens = F.split(v, " ")
    return [
        F.regexp_extract(v, HOST_PATTERN, 1).alias("host"),
        F.regexp_extract(v, TIMESTAMP_PATTERN, 1).alias("timestamp"),
        F.regexp_extract(v, REQUEST_PATTERN, 1).alias("request"),
        F.try_element_at(tokens, F.lit(-2)).try_cast("int").alias("status"),
        F.try_element_at(tokens, F.lit(-1)).try_cast("int").alias("bytes"),
    ]


def org_key(host: str | Column, labels: int | Column) -> Column:
    """Organisation of a host: its last ``labels`` (2 or 3) name labels.

    Never null ('' for a null host), so joins on it infer no null filter that
    Catalyst would copy below the parse.
    """
    h = F.col(host) if isinstance(host, str) else host
    three = F.regexp_extract(h, ORG_PATTERN_3, 1)
    two = F.regexp_extract(h, ORG_PATTERN_2, 1)
    if isinstance(labels, int):
        key = three if labels == 3 else two
    else:
        key = F.when(labels == 3, three).otherwise(two)
    return F.coalesce(key, F.lit(""))


def day_of(timestamp: str | Column = "timestamp") -> Column:
    """Day label: the text before the first '/' of the log time."""
    t = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.get(F.split(t, "/"), 0)


def hour_of(timestamp: str | Column = "timestamp") -> Column:
    """Hour label: the text between the first and second ':'.

    Null when the time has no ':' (``get`` tolerates the missing item; a
    plain index would fail the job under ANSI mode).
    """
    t = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.get(F.split(t, ":"), 1)


def log_time(timestamp: str | Column = "timestamp") -> Column:
    """Typed log-local time (timestamp_ntz) from the text; null if malformed.

    The zone offset is dropped on purpose: day and hour labels are log-local,
    so the typed value is too.
    """
    t = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    local = F.substring_index(t, " ", 1)
    return F.try_to_timestamp(local, F.lit(LOG_TIME_FORMAT)).cast("timestamp_ntz")
