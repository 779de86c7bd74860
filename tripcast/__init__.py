"""tripcast: trip-event analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own expressions; see README.md for the module map.
"""

from tripcast.config import Rules, DEFAULT_RULES, get_session

__all__ = ["Rules", "DEFAULT_RULES", "get_session"]
