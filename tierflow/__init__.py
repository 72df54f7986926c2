"""tierflow: layered (raw -> bronze -> silver -> gold -> warehouse) food
recommendation and user-profile analytics on PySpark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions``; planning is left to Catalyst.
"""

__version__ = "0.1.0"
