"""Sales-event validation, enrichment and analytics on Spark.

Every transform is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so the same code runs on static tables and on Structured
Streaming frames.
"""

from salespark.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
