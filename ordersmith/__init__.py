"""ordersmith: multi-channel order analytics on Spark.

Layers (each a DataFrame -> DataFrame function in ``operators``):
staging with in-row data-quality flags, a unified stack of both feeds,
latest-version dedupe and canonical columns, the order fact with one
revenue rule, and the marts (daily KPIs, customer dimension, freshness).
``plans.pipeline`` composes them; ``plans.sinks`` writes the tables.
"""
