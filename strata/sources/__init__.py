from strata.sources.landing import parse_json, read_landed  # noqa: F401
from strata.sources.sinks import (  # noqa: F401
    TableStore,
    align_to,
    append_table,
    cluster_rewrite,
    compact,
    ensure_database,
    evolve_table,
    load_kind,
    overwrite_table,
    table_exists,
    with_audit,
    write_if_any,
    write_table,
)
