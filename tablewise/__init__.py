"""tablewise: table profiling, constraint suggestion and drift detection on Spark.

Everything is expressed with the public DataFrame / ML APIs so that Catalyst
plans the scans (pushdown, pruning) and aggregations (partial + final).

Sub-packages
------------
functions  column-expression helpers (portable hashes, time predicates, safe maths)
sources    readers and sinks (JDBC, path formats, CSV, metric / suggestion sinks)
operators  profile, suggestion, slicing, sampling, features, corruption, drift, SHAP
plans      end-to-end jobs and run parameters
streaming  micro-batch adapter (the batch operators applied per micro-batch)
"""

from tablewise.session import get_spark, shared_dir  # noqa: F401

__version__ = "0.1.0"
