"""Training-data operators: one module for each operator, all on DataFrames.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries where it is installed.
"""
