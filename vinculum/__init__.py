"""vinculum: a Spark-native catalog-matching and de-duplication engine.

Every stage is a pure ``DataFrame -> DataFrame`` transform built from Spark
built-in functions, joins, aggregates and windows.  The only Python hook is
the optional tier-2 resolver (``operators.resolve.resolve_with_function``),
which runs through ``mapInPandas``.
"""

__all__ = ["session", "schemas"]
