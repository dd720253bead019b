"""kestrel: causal event-timeline features, priors, ranking and profiling on Spark.

Subpackages: ``sources`` (inputs, timeline, sinks), ``functions`` (per-row
expressions, window specs), ``operators`` (the feature blocks and
algorithms), ``plans`` (assembled pipelines and the registered queries),
``llm`` (training-data operators; nothing else imports it).
"""

__version__ = "0.1.0"
