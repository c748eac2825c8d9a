"""tidegrid: prepare, forecast and score many time series at once on Spark.

Every public function takes and returns Spark DataFrames keyed by ``series_id``.
"""

from tidegrid.session import get_session
from tidegrid.spec import Spec

__all__ = ["Spec", "get_session"]
