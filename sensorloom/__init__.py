"""Ingestion, conformance, reporting and resampling of building-sensor telemetry on Spark.

Every public function takes and returns DataFrames (or Columns), so calls chain with
``DataFrame.transform``.  Nothing here runs an action unless its name says it writes.
"""
