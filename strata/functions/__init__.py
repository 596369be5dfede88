from strata.functions.scalars import (  # noqa: F401
    BLANK_DEFAULT,
    LOW_WATER_DEFAULT,
    blank_to_null,
    clean_string,
    epoch_to_ntz,
    epoch_to_timestamp,
    instant_to_utc,
    safe_date,
    safe_timestamp,
)
