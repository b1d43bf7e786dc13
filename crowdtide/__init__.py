"""Population profiling on Spark: location signals in, area head counts and profiles out.

Operators take DataFrames and return DataFrames. Reading lives in ``sources`` and
``streaming``, writing in ``sinks``, whole jobs in ``plans``.
"""
