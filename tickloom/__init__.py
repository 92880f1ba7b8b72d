"""Market price and community sentiment analytics as Spark DataFrame operators.

Layers: ``sources`` (payloads, lake tables, sinks), ``functions`` (Column
builders), ``operators`` (frame-to-frame transforms), ``plans`` (staging, marts,
quality suite, daily run) and ``streaming`` (trade ticks).
"""
