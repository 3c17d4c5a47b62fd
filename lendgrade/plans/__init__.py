"""Compositions: the lazy stage graph, sinks, catalog objects, the staged
batch job, and the driver query registry with its SQL oracle."""
