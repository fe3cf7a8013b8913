"""Load, conform, merge, publish and verify star-schema marts with Spark DataFrames."""

from martweave.model import ForeignKey, TableAction, TableSpec
from martweave.session import build_session, parked, scratch_scope

__all__ = ["ForeignKey", "TableAction", "TableSpec", "build_session", "parked", "scratch_scope"]
