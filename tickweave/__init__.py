"""tickweave: price-bar (OHLCV) analytics as Spark DataFrame plans.

Every operator takes and returns a DataFrame.  Series are identified by key
columns (default ``symbol, timeframe``) and ordered by ``timestamp``.
Long series are cut into fixed row segments so that no window, carry or
aggregate ever needs one whole series in one task (see
``tickweave.operators.series``).
"""

from tickweave.schema import KEYS, TS, OHLCV_SCHEMA, TIMEFRAMES  # noqa: F401

__version__ = "0.1.0"
