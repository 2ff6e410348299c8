"""skewsafe: skew-safe order aggregation, storage and reporting on Spark.

Every operator takes and returns a ``DataFrame``; the only actions are the
writes in :mod:`skewsafe.sinks` and the bounded collects in
:mod:`skewsafe.operators.skew`.
"""

from skewsafe.session import build_session, configure_session, shared_dir

__all__ = ["build_session", "configure_session", "shared_dir"]
__version__ = "0.1.0"
