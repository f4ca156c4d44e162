"""wishrank: wishlist recommendation lists as Spark DataFrame plans."""

from .params import DEFAULT, Params
from .plans.recommend import Recommender
from .sources.inputs import Inputs, DerivedInputs, catalog_inputs
from .sources.context import current_database
from .sources.insert import insert_by_position
from .sources.publish import ResultStore
from .sources.sinks import publish_results, write_results

__all__ = [
    "DEFAULT",
    "Params",
    "Recommender",
    "Inputs",
    "DerivedInputs",
    "ResultStore",
    "catalog_inputs",
    "current_database",
    "insert_by_position",
    "publish_results",
    "write_results",
]
