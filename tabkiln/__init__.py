"""tabkiln: Spark-native operators for the data work around tabular and text models.

Every operator takes a DataFrame and returns a DataFrame (or a small fitted
model whose ``transform`` is a lazy projection).  Heavy work stays inside
Catalyst plans: aggregations, joins, windows and higher-order functions.
"""

from tabkiln.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
