"""basketflow: repeat-purchase analytics on order histories, built from Spark DataFrame jobs.

Layout
  sources/    scans, the retail view over the given tables, stage tables and sinks
  functions/  column expressions shared by operators (ratios, decay weights, id lists)
  operators/  DataFrame -> DataFrame operators: features, baselines, decisions, models
  plans/      the named queries (Spark side) and their SQL oracles
  streaming/  empty by design: the modelled workload has no streams
"""

from basketflow.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
