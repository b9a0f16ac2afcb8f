"""presswork: daily news text analytics as Spark DataFrame jobs.

Every operator is a DataFrame -> DataFrame function (usable with
``df.transform``); the core work runs as Spark joins, windows and
aggregations.
"""

from presswork.session import get_spark, checkpoint_dir  # noqa: F401
