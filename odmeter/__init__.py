"""Origin-destination distance enrichment on Spark.

Every operator takes DataFrames and returns DataFrames.  Actions happen only where a result must land
(``sinks``, ``plans.ingest``, ``plans.maintain``, ``streaming``) or where a month list of calendar size is
needed to build the next plan.
"""

from odmeter.context import RunContext
from odmeter.session import build_session

__all__ = ["RunContext", "build_session"]
