"""Spark-native feature building and scoring for multi-table entity data.

Child tables are cleaned, encoded and aggregated to one row per entity, joined
to the entity table, pruned and scored.  Everything is expressed as DataFrame
and MLlib plans; nothing is pulled through the driver except bounded summaries
such as category lists, column statistics and fold metrics.
"""
