"""School-board analytics as Spark DataFrame jobs.

Layers: ``sources`` (typed inputs, seeds, sinks) -> ``functions`` (Column helpers)
-> ``operators`` (reusable DataFrame building blocks) -> ``plans`` (one function per
domain table or report) -> ``catalog`` (the registered driver queries).
"""
