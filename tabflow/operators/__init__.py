"""Relational operators, data-quality checks, staging sinks, exact quantiles."""

from tabflow.operators.checks import (  # noqa: F401
    Check,
    CheckFailed,
    accepted_values,
    assert_checks,
    field_is,
    holds,
    in_range,
    is_floating,
    no_nulls,
    no_nulls_all,
    not_empty,
    run_checks,
    unique,
)
from tabflow.operators.incremental import (  # noqa: F401
    ChangedFile,
    MergeableState,
    Refreshed,
    imported_files,
    rebuild,
    refresh,
    source_files,
)
from tabflow.operators.copartition import CoPartitioned, read_copartitioned, stage_copartitioned  # noqa: F401
from tabflow.operators.quantiles import (  # noqa: F401
    exact_median,
    exact_quantiles,
    quantiles_of_counts,
    value_counts,
)
from tabflow.operators.relational import (  # noqa: F401
    complete_categories,
    describe_column,
    distinct_sorted,
    enforce_columns,
    enrich,
    filter_in,
    filter_min,
    frequency,
    histogram,
    row_count,
    salted_enrich,
    top_n,
)
from tabflow.operators.sketches import quantile_sketches, rank_error, sketch_state, sketched_quantiles  # noqa: F401
from tabflow.operators.sql_names import table_references  # noqa: F401
from tabflow.operators.staging import (  # noqa: F401
    AuditResult,
    clustered,
    drop_ref,
    export_csv,
    export_csv_ordered,
    new_ref,
    publish,
    query,
    read_csv_ordered,
    read_range,
    read_staged,
    read_table,
    stage_table,
    staged_path,
    write_audit,
    write_table,
)
from tabflow.operators.versions import (  # noqa: F401
    PublishConflict,
    Version,
    expire_versions,
    find_version,
    publish_version,
    read_version,
    version_path,
    versions,
    write_version,
)
