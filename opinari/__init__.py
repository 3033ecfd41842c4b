"""opinari — review-text analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from Catalyst expressions, so filters and projections reach the Parquet
scan and all heavy work runs inside whole-stage codegen on the executors.
"""

__version__ = "0.1.0"
