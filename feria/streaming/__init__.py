"""Structured Streaming: incremental keyed loads.

The reference refreshes in batches and appends with insert-ignore
semantics; :mod:`feria.streaming.incremental` runs the same keyed append for
files arriving in a folder, one micro-batch at a time."""
