"""feria: marketplace analytics on Spark DataFrames.

Layers (each a lazy DataFrame plan, nothing collected on the driver):

* ``sources``    raw readers, driver-table bindings, sinks, star load
* ``functions``  pure Column expressions (text, time, numeric helpers)
* ``operators``  reusable DataFrame -> DataFrame operators
                 (keyed dedup, skew-safe mode / arg-max, profiling, checks)
* ``plans``      the jobs a user runs: cleaning, marts, star schema,
                 analytics Q1-Q5, dashboard variants, exploration reports
* ``streaming``  incremental keyed (insert-ignore) loads with Structured Streaming
"""

__version__ = "0.1.0"
