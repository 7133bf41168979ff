"""Event-time analytics as plain PySpark DataFrame functions.

``sources``    feed and table readers, record schemas
``functions``  column expressions: codecs, event time, durations, reports
``operators``  windows, windowed joins, top-N, lateness (batch form)
``streaming``  watermarks and the streaming form of the stateful operators, sinks
``plans``      the finished queries, put together from the above
"""
