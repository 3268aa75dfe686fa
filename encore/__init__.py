"""encore — Spark-native operators for implicit-feedback recommendation data.

Every public operator is a ``DataFrame -> DataFrame`` function whose column
names are parameters, so it composes with ``df.transform(...)``.  The heavy
lifting is always done by Spark (Catalyst plans, shuffles, windows, Spark ML);
nothing is collected to the driver except bounded metadata.
"""

__version__ = "0.1.0"
