"""ratecraft: population-rate analytics and multi-target regression on Spark.

Every operator is a function over Spark DataFrames (or a small fitted object whose
state is a DataFrame / Spark ML model). Work runs on executors; the driver only
plans jobs and handles parameter-sized results (a handful of numbers per column).
"""

from ratecraft.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
