"""daybook: daily warehouse loads and fraud reporting as Spark jobs.

Every operator is a pure ``DataFrame -> DataFrame`` function: the caller
owns the session, the sources and the sinks.  Nothing is collected to the
driver; all relational work is planned by Catalyst and executed by Spark.
"""

from daybook import constants, schemas  # noqa: F401

__all__ = ["constants", "schemas"]
