"""flightlake: aircraft state-vector lake analytics, expressed as Spark DataFrame plans.

Every operator is a plain ``DataFrame -> DataFrame`` function. Layers:

* ``sources``   readers and writers (JSON snapshots, parquet layers, file lineage)
* ``functions`` column expressions (array positions, safe casts, phase / proximity rules, calendar parts)
* ``operators`` relational building blocks (silver cleaning, split-lag flight phase, grid geofence,
                country statistics, profiles, calendar, report marts, dedupe, bounded joins)
* ``plans``     whole jobs (silver, gold fan-out, pipeline) and the query registry used by the driver
* ``streaming`` the incremental raw -> silver path with Structured Streaming
"""

__version__ = "0.1.0"
