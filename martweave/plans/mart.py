"""One refresh of a mart: merge the extracts that arrived, act on the stored tables, publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted
from martweave.model import FACT, TableAction, TableSpec
from martweave.operators.keys import lost_keys
from martweave.operators.sizing import key_size
from martweave.plans.merge import merge_extracts
from martweave.plans.publish import apply_actions, current_sequence, new_run_id, publish_release, published_tables
from martweave.session import parked, path_exists, scratch_scope


@dataclass(frozen=True)
class Refresh:
    """The release's log rows and, per table, the refused rows as they were written."""

    release: DataFrame
    rejects: dict[str, DataFrame]


def actions_for(specs: Sequence[TableSpec], conditions: dict[str, str | Column] | None = None) -> list[TableAction]:
    """Dimensions arrive as full snapshots and are replaced; then facts, incremental, are upserted.

    ``conditions`` names, per fact, the stored rows to delete before the upsert.
    """
    conditions = conditions or {}
    return [
        TableAction("upsert", spec.name, keys=spec.primary_key, condition=conditions.get(spec.name))
        if spec.kind == FACT
        else TableAction("replace", spec.name)
        for spec in sorted(specs, key=lambda s: s.kind == FACT)
    ]


def _orphans_of_lost_keys(
    specs: Sequence[TableSpec], stored: dict[str, DataFrame], changed: dict[str, DataFrame]
) -> dict[str, list[DataFrame]]:
    """Take the facts whose dimension row left out of ``changed`` and return them with their reason.

    Stored facts matched the stored dimension, so only keys that left it can orphan them. As these
    are usually few, the facts are searched for them rather than checked against the dimension again.
    """
    found: dict[str, list[DataFrame]] = {}
    for spec in specs:
        for fk in spec.foreign_keys if spec.name in stored else ():
            if fk.references not in stored:
                continue
            lost = parked(lost_keys(stored[fk.references], changed[fk.references], fk), "lost-keys")
            size = key_size(lost, fk.columns)
            if not size.keys:
                continue
            lost, fact = (F.broadcast(lost) if size.small else lost), changed[spec.name]
            reasons = F.array(F.lit(f"no match in {fk.references}")).alias("reject_reasons")
            found.setdefault(spec.name, []).append(fact.join(lost, list(fk.columns), "left_semi").select(*map(quoted, fact.columns), reasons))
            changed[spec.name] = fact.join(lost, list(fk.columns), "left_anti").select(*map(quoted, fact.columns))
    return found


def refresh_mart(
    spark: SparkSession,
    root: str,
    specs: Sequence[TableSpec],
    inputs: dict[str, Sequence[DataFrame]],
    run_id: str | None = None,
    conditions: dict[str, str | Column] | None = None,
) -> Refresh:
    """Merge ``inputs``, apply them to the published tables and publish the result under ``root``.

    The first refresh creates the mart. Refused rows are written to ``<root>/rejects``, so that
    nothing disappears. With a dimension row that left go the facts that point at it, stored ones
    included; they are refused as well. A failure anywhere leaves the previous release current.
    """
    root, run_id = root.rstrip("/"), run_id or new_run_id()
    partition_by = {spec.name: spec.partition_by for spec in specs}
    rejects: dict[str, DataFrame] = {}
    with scratch_scope(spark):
        merged = merge_extracts(specs, inputs, park_facts=True)
        # The number first: a release in between then counts as a later one.
        base = current_sequence(spark, root) if path_exists(spark, f"{root}/releases") else 0
        stored = published_tables(spark, root)
        changed = apply_actions(stored, merged.tables, actions_for(specs, conditions))
        orphans = _orphans_of_lost_keys(specs, stored, changed)
        for name, refused in merged.rejects.items():
            for rows in orphans.get(name, ()):
                refused = refused.unionByName(rows, allowMissingColumns=True)
            path = f"{root}/rejects/{run_id}/{name}"
            refused.write.mode("overwrite").parquet(path)
            rejects[name] = spark.read.schema(refused.schema).parquet(path)
        release = publish_release(spark, root, changed, run_id, partition_by, base)
    return Refresh(release, rejects)
