"""rillet: Spark-native batch ETL operators and the flows built from them.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column``) function made of
built-in Spark expressions, joins, aggregates and windows, so Catalyst plans,
prunes and pushes down the whole chain.
"""

from rillet.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
