"""accessaudit: audit access to monitored web services with PySpark DataFrames.

Layout
------
functions   column expressions (no actions, no state)
operators   DataFrame -> DataFrame steps of the audit
sources     record streams, table scans, offsets, sinks
streaming   the micro-batch job built from the same operators
plans       the end-to-end audit and the registered queries
"""
