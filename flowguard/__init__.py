"""flowguard: labelled flow-table analytics on Spark.

Every operator is a function from DataFrame(s) to DataFrame; the work runs on the
cluster and the driver only sees small, bounded tables (statistics, class lists,
model parameters).
"""

from flowguard.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
