"""corpuslens: Spark-native text-corpus preparation and evaluation analytics.

Every operator is a function from DataFrame(s) to a DataFrame built from
``pyspark.sql.functions`` expressions, joins and aggregations, so Catalyst
plans and Tungsten executes the whole job.  Python runs on executors only
where a user supplies a model function (``operators.generate``) or an
encoder (``operators.vectors``).
"""

from corpuslens.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
