"""flowlens: funnel, retail-sales and fraud-classification analytics as Spark DataFrame plans.

Sub-packages
------------
sources    typed readers, sinks and the adapters that map the driver tables onto domain views
functions  column-expression helpers (safe division, canonicalisation, labels)
operators  reusable DataFrame operators: aggregates, top-k, reshaping, windows, exact ranking,
           sampling, scaling, gradient descent, evaluation, graph specs, ML-library wrappers
plans      composite analyses (funnel, sales drill-down, hierarchy, rebalancing comparison)
streaming  the same aggregates over a Structured Streaming source
"""

__version__ = "0.1.0"
