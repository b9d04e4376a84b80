"""jobnest: Spark-native batch pipeline for nested JSON job-vacancy data.

Every operator is a ``DataFrame -> DataFrame`` function meant to be used with
``df.transform(...)``; the heavy lifting (parsing, explode, joins, windows,
aggregation) stays inside Catalyst/Tungsten.
"""

from jobnest.session import get_session, work_root

__all__ = ["get_session", "work_root"]
