"""Urban-mobility analytics as Spark DataFrame functions.

Layers: ``sources`` (landed files, tables) -> ``plans`` (staging, intermediate
and mart models) with ``functions`` (column expressions) and ``operators``
(lookup joins, merge, data quality) underneath, and ``streaming`` beside them.
Every public function takes DataFrames and returns a DataFrame.
"""

__version__ = "0.1.0"
