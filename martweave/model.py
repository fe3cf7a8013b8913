"""Declarative metadata: keys, roles and actions of the tables in a mart."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import StructType

FACT = "fact"
DIMENSION = "dim"


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of the owning table point at ``ref_columns`` of table ``references``."""

    columns: tuple[str, ...]
    references: str
    ref_columns: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.columns) != len(self.ref_columns) or not self.columns:
            raise ValueError(f"foreign key to {self.references} needs matching column lists")


@dataclass(frozen=True)
class TableSpec:
    """Keys and role of one table. Spark enforces no keys, so the jobs in ``plans`` do."""

    name: str
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    kind: str = DIMENSION
    schema: StructType | None = None
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in (FACT, DIMENSION):
            raise ValueError(f"{self.name}: kind must be '{FACT}' or '{DIMENSION}'")

    @property
    def load_mode(self) -> str:
        """Facts arrive incrementally, dimensions as full snapshots."""
        return "incremental" if self.kind == FACT else "full"


@dataclass(frozen=True)
class TableAction:
    """One step of an action list: what to do with ``target``, from which ``source``."""

    action: str
    target: str
    source: str | None = None
    condition: str | Column | None = None
    keys: tuple[str, ...] = field(default=())
    latest_by: tuple[str, ...] = field(default=())
