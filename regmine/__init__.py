"""regmine: Spark-native profiling, cleaning, statistics and pattern mining
for tables of administrative records.

Every public operator is ``DataFrame (+ params) -> DataFrame`` built on the
Spark SQL / Spark ML public APIs.
"""

from regmine.session import checkpoint_dir, get_session, materialize  # noqa: F401

__version__ = "0.1.0"
