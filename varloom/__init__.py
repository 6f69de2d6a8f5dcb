"""Variant analytics as composable Spark DataFrame operators.

Every public operator takes DataFrames or Columns and returns them; nothing holds a session and nothing is collected
to the driver. ``functions`` holds row-level rules, ``operators`` joins and aggregates, ``sources`` readers, writers
and catalog helpers, ``plans`` whole reports.
"""
