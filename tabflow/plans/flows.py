"""End-to-end flows: import with schema control into a
staging area, audit, then run a pipeline on the staged data. Nothing is ever
published here; ``operators.staging.publish`` is the separate, explicit step.

Each stage reads what the previous one wrote, so a lost executor only
re-runs the stage it was in, never the whole lineage from the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabflow.operators.checks import Check, assert_checks, field_is, not_empty, run_checks, unique
from tabflow.operators.staging import AuditResult, new_ref, read_table, stage_table, write_audit
from tabflow.plans import conversion, engagement, trips
from tabflow.sources import override_types, read_parquet_glob, read_source


def import_table(
    spark: SparkSession,
    uri: str,
    table: str,
    ref: str | None = None,
    overrides: Mapping[str, str | T.DataType] | None = None,
    checks: Sequence[Check] | None = None,
    fmt: str = "parquet",
    root: str | None = None,
    raise_on_failure: bool = True,
    schema: T.StructType | str | None = None,
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
) -> AuditResult:
    """Detect the source schema, apply type overrides, stage the table under
    ``ref`` and audit it (not empty, plus one ``field_is`` per override). The
    staged table is kept whether the audit passes or fails. CSV sources take
    an explicit ``schema`` (else types are inferred in one extra pass).
    ``partition_by`` writes the staged table in directories by those columns
    (e.g. a pickup date), so later range filters prune whole directories;
    ``cluster_by`` writes sorted files of disjoint ranges instead, whose row
    groups prune the same filters."""
    ref = ref or new_ref("import")
    overrides = dict(overrides or {})
    if fmt == "parquet" and schema is None:
        df = read_parquet_glob(spark, uri, overrides)
    else:
        df = override_types(read_source(spark, uri, fmt, schema), overrides)
    gate = list(checks) if checks is not None else [not_empty()]
    for column, type_name in overrides.items():
        name = type_name if isinstance(type_name, str) else type_name.simpleString()
        gate.append(field_is(column, name))
    return write_audit(
        df,
        table,
        ref,
        gate,
        root=root,
        raise_on_failure=raise_on_failure,
        partition_by=partition_by,
        cluster_by=cluster_by,
    )


@dataclass
class FlowResult:
    ref: str
    imported: AuditResult
    outputs: dict[str, str] = field(default_factory=dict)
    checks: dict[str, list] = field(default_factory=dict)


def run_taxi_flow(
    spark: SparkSession,
    trips_uri: str,
    zones: DataFrame,
    ref: str | None = None,
    miles_as_text: bool = False,
    start: str = trips.WINDOW_START,
    end: str = trips.WINDOW_END,
    root: str | None = None,
) -> FlowResult:
    """Import the trips (optionally storing ``trip_miles`` as text), then
    build ``trips_and_zones`` and ``top_pickup_locations`` in the same ref.
    A location listed twice in ``zones`` would multiply trips, so it fails the
    flow. The strict cast in ``trips_and_zones`` makes both variants give the same
    tables; the ``is_floating`` expectation is recorded (warn severity)."""
    assert_checks(run_checks(zones, [unique("LocationID")]))
    ref = ref or new_ref("taxi")
    overrides = {"trip_miles": "string"} if miles_as_text else None
    imported = import_table(spark, trips_uri, "taxi_trips", ref, overrides, root=root)
    staged = imported.staged(spark)
    joined = trips.trips_and_zones(staged, zones, start, end)
    joined_path, _ = stage_table(joined, "trips_and_zones", ref, root)
    joined_staged = read_table(spark, joined_path)
    expectation = [r.asDict() for r in run_checks(joined_staged, trips.trips_checks()).collect()]
    top = trips.top_pickup_locations(joined_staged)
    top_path, _ = stage_table(top, "top_pickup_locations", ref, root)
    return FlowResult(
        ref,
        imported,
        {"trips_and_zones": joined_path, "top_pickup_locations": top_path},
        {"trips_and_zones": expectation},
    )


def run_conversion_flow(
    spark: SparkSession,
    events_uri: str,
    users: DataFrame,
    ref: str | None = None,
    root: str | None = None,
) -> FlowResult:
    """Import the session events, build ``conversion_by_segment`` in the same
    ref and gate it with the conversion checks (raises on failure, also when
    ``users`` lists a user twice, which would count sessions twice; the staged
    tables stay for debugging)."""
    assert_checks(run_checks(users, [unique("user_id")]))
    ref = ref or new_ref("conversion")
    imported = import_table(spark, events_uri, "sessions", ref, root=root)
    sessions = conversion.session_conversion(imported.staged(spark))
    by_segment = conversion.conversion_by_segment(sessions, users)
    audited = write_audit(by_segment, "conversion_by_segment", ref, conversion.conversion_checks(), root=root)
    return FlowResult(
        ref,
        imported,
        {"conversion_by_segment": audited.path},
        {"conversion_by_segment": audited.checks},
    )


def run_engagement_flow(
    spark: SparkSession,
    uri: str,
    ref: str | None = None,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    score: str = engagement.SCORE,
    measures: Sequence[str] = (engagement.SCORE, engagement.MINUTES),
    root: str | None = None,
) -> FlowResult:
    """Import the users file (CSV by default) into a fresh ref, then the two
    nodes: ``user_segments`` (score cut at its exact terciles) and
    ``segment_summary``, both staged in the same ref."""
    ref = ref or new_ref("engagement")
    imported = import_table(spark, uri, "engagement_users", ref, fmt=fmt, schema=schema, root=root)
    segmented = engagement.user_segments(imported.staged(spark), score)
    seg_path, _ = stage_table(segmented, "user_segments", ref, root)
    summary = engagement.segment_summary(read_table(spark, seg_path), measures)
    sum_path, _ = stage_table(summary, "segment_summary", ref, root)
    return FlowResult(ref, imported, {"user_segments": seg_path, "segment_summary": sum_path})
