"""Scalar expressions: defaults, prefixes, retention, priorities, paths and log lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed values.
PRIORITY_MARKERS = {"DLE": 1, "_MR_": 2}
LOOSE_PRIORITY_MARKERS = {"DLE": 1, "MR": 2}
LOWEST_PRIORITY = 3
NEXT_STAGE = {"extract": "hyper", "hyper": "publish", "publish": "completed"}
STAGE_STATUSES = ("started", "pending", "failed", "completed")
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RETENTION_DAYS = 60

_LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (.*): (.*)$"
_STAGE_PATH = r"([^/.]+)\.([^/.]+)/([^/]+)/?$"


def typed_null(data_type: DataType | str) -> Column:
    """NULL of a given type."""
    return F.lit(None).cast(data_type)


def with_prefix(prefix: str, column: Column | str) -> Column:
    """``prefix`` followed by the value; NULL stays NULL."""
    return F.concat(F.lit(prefix), _col(column))


def default_if_null(column: Column | str, default, data_type: DataType | str) -> Column:
    """The value, or ``default`` cast to the column's own type.

    Unlike ``fillna`` this also works when the default has another type than the column.
    """
    return F.coalesce(_col(column), F.lit(default).cast(data_type))


def days_before(as_of: dt.date | dt.datetime, days: int = RETENTION_DAYS) -> dt.datetime:
    """Retention limit for a fixed ``as_of``; the clock is never read, so results repeat."""
    day = as_of if isinstance(as_of, dt.datetime) else dt.datetime.combine(as_of, dt.time())
    return day - dt.timedelta(days=days)


def timestamp_literal(moment: dt.datetime | str) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def priority_class(name: Column | str, loose: bool = False) -> Column:
    """Class of a job name; the first marker that occurs in it wins."""
    markers = LOOSE_PRIORITY_MARKERS if loose else PRIORITY_MARKERS
    expression = F
    for marker, rank in markers.items():
        expression = expression.when(F.contains(_col(name), F.lit(marker)), F.lit(rank))
    return expression.otherwise(F.lit(LOWEST_PRIORITY))


def next_stage(stage: Column | str, succeeded: Column | None = None) -> Column:
    """Stage that follows a finished one; unsuccessful work ends as ``failed``."""
    flow = F.create_map(*[F.lit(v) for pair in NEXT_STAGE.items() for v in pair])
    following = F.coalesce(F.try_element_at(flow, _col(stage)), _col(stage))
    return following if succeeded is None else F.when(succeeded, following).otherwise(F.lit("failed"))


def stage_path(stage: Column, status: Column | str, name: Column) -> Column:
    """``stage.status/name``."""
    state = F.lit(status) if isinstance(status, str) else status
    return F.concat(stage, F.lit("."), state, F.lit("/"), name)


def stage_path_parts(path: Column | str) -> tuple[Column, Column, Column]:
    """Stage, status and job name of a ``stage.status/name`` path."""
    stage, status, name = (F.regexp_extract(_col(path), _STAGE_PATH, i) for i in (1, 2, 3))
    return stage.alias("stage"), status.alias("status"), name.alias("name")


def path_name(path: Column | str) -> Column:
    """Last part of a path, query string and fragment excluded."""
    return F.regexp_extract(_col(path), r"([^/?#]*)/?(?:[?#].*)?$", 1)


def path_stem(path: Column | str) -> Column:
    """Last part of a path without its extension."""
    return F.regexp_replace(path_name(path), r"(?<=.)\.[^.]*$", "")


def printed_bytes(columns: Sequence[str]) -> Column:
    """Bytes of a row printed as one delimited line: its values in UTF-8, and a separator after each. NULL prints as nothing."""
    total = F.lit(len(columns)).cast("bigint")
    for column in columns:
        total = total + F.coalesce(F.octet_length(quoted(column).cast("string")), F.lit(0))
    return total


def list_values(text: Column | str) -> Column:
    """Trimmed members of a quoted comma-separated list; empty members are dropped."""
    members = F.split(F.regexp_replace(_col(text), '"', ""), ",")
    return F.filter(F.transform(members, lambda member: F.trim(member)), lambda member: member != "")


def log_line(moment: Column, name: Column, status: Column) -> Column:
    """One run-log line."""
    return F.concat(F.date_format(moment, LOG_TIME_FORMAT), F.lit(" - "), name, F.lit(": "), status)


def parse_log_line(line: Column | str) -> tuple[Column, Column, Column]:
    """Timestamp, name and status of a run-log line (NULL timestamp when it is none, or no real moment)."""
    moment = F.nullif(F.regexp_extract(_col(line), _LOG_LINE, 1), F.lit(""))
    return (
        moment.try_cast("timestamp_ntz").alias("ts"),
        F.regexp_extract(_col(line), _LOG_LINE, 2).alias("name"),
        F.regexp_extract(_col(line), _LOG_LINE, 3).alias("status"),
    )


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row.

    ``xxhash64`` skips NULLs, so each column contributes its value and whether it is NULL.
    """
    parts = [part for name in columns for part in (_col(name), _col(name).isNull())]
    return F.xxhash64(*parts)


def _col(column: Column | str) -> Column:
    return quoted(column) if isinstance(column, str) else column


def quoted(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")
