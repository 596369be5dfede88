from strata.operators.columns import (  # noqa: F401
    NameCollision,
    apply_types,
    clean_strings,
    explode_rows,
    fill_numbers,
    flatten_structs,
    normalize_names,
    normalized_name,
    require_keys,
    with_date_parts,
    with_parent_id,
)
from strata.operators.increment import (  # noqa: F401
    high_water,
    high_water_frame,
    increment_by_version,
    increment_by_watermark,
    latest_by_key,
    new_rows,
)
from strata.operators.joins import (  # noqa: F401
    hot_keys,
    join_dimension,
    measure_small,
    salted_join,
    skew_join,
    skew_report,
)
from strata.operators.marts import (  # noqa: F401
    Star,
    avg_runtime,
    build_marts,
    cast_shows,
    common_tags,
    episodes_per_season,
    fact_summary,
    top_k,
    top_members,
    with_rank,
)
from strata.operators.setops import common_type, row_counts, union_all_by_name  # noqa: F401
