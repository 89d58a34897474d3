"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tickweave.functions.core import (  # noqa: F401
    epoch_us,
    from_epoch_us,
    nan_to_null,
    rounded,
    safe_div,
    tf_seconds,
    to_utc_timestamp_col,
)
