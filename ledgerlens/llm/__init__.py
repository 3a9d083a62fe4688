"""Training-data pipeline operators: one module per operator.

Nothing outside this package imports it; its queries and SQL are in
``registry`` and the top-level entry adds them when the package is present.
"""
