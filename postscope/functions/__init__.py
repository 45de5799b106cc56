"""Column expressions: every function returns a ``Column`` and stays JVM-side,
except ``normalize_handle`` (a guarded pandas UDF, see ``handles``)."""

from postscope.functions.days import day_of, post_day_prefix, post_day_utc, parse_ts  # noqa: F401
from postscope.functions.handles import lower_handle, normalize_handle  # noqa: F401
