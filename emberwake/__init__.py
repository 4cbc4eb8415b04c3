"""emberwake: a Spark-native toolkit for strict delimited loads, event-table
shaping (batch and streaming) and gradient-boosted trees.

Subpackages
-----------
sources    schema specs, strict delimited scans, file listings, literal points
sinks      table writes, schema/profile listings, class-partitioned writes
functions  column expressions (bit masks, key labels, second keys, dispatch)
operators  event operators (windows, top-k, take-until, throttle, look-ups)
           and boosting (ML estimator wrapper, second-order histogram fit)
plans      the end-to-end load job and the query catalogue
streaming  Structured Streaming forms of the event operators
"""

from emberwake.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
