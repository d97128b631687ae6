"""Sources and sinks: raw CSV readers, driver-table bindings, Parquet / CSV
writers and keyed (insert-ignore) appends."""
