"""qualis: support-quality analytics (QA warehouse) as Spark DataFrame plans.

Layers: ``sources`` (landed files, raw fixtures, versioned warehouse),
``functions`` (column expressions), ``operators`` (lookups, incremental
loads, merge), ``plans`` (staging, dimensions, facts, marts, metrics,
checks, the warehouse build).
"""

__version__ = "0.1.0"
