"""shoalkit: field-survey data work (cleaning, keys, quality rules, integrity checks,
effort/CPUE products, reports) as lazy Spark DataFrame operators.

Main entry points::

    from shoalkit.plans import jobs            # extract / load / release workflows
    from shoalkit.plans import effort, etl, products, views, warehouse, load
    from shoalkit.operators import quality, integrity, joins, keys, aggregate
    from shoalkit.sources.dbf import read_dbf  # spark.read.format("dbf")
    from shoalkit.functions import nulls, geo  # three-valued helpers, UTM columns

Nothing here creates a Spark session; every function takes DataFrames (or the session
they belong to) and returns lazy DataFrames.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
