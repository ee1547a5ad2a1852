"""tickwise: market time-series analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (usable with
``df.transform``); none of them runs an action.  Series-wise work (rolling
windows, recursive averages, cumulative products) is split into row blocks
so that one heavy ticker never lands in a single task; see
``tickwise.plans.series``.
"""

from tickwise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
