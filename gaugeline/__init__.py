"""Sensor-event lake and analytics on Spark.

Every step is a DataFrame -> DataFrame function, so the same code serves batch
jobs and Structured Streaming. Only ``sources``, ``sinks`` and ``streaming``
touch storage.
"""
