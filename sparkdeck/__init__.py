"""sparkdeck: batch analytics jobs expressed as PySpark DataFrame plans.

Every operator is a plain function from DataFrames (plus parameters) to a
DataFrame.  Nothing here holds a global session: callers pass DataFrames in,
and the few operators that must write (sinks, lineage cuts) take the session
from the DataFrame they were given.

Layout
------
``functions``  column expressions (Java text rules, numeric transforms, encoders)
``sources``    line / delimited / CSV readers and the text and CSV sinks
``operators``  relational, words, ratings, linear algebra, profiling,
               feature preparation, models, evaluation, tuning
``plans``      bindings from the driver's tables to operator inputs and the
               registered queries with their SQL oracles
``jobs``       the batch jobs as commands over input / output paths
"""

from sparkdeck.session import build_session, shared_dir  # noqa: F401

__all__ = ["build_session", "shared_dir"]
