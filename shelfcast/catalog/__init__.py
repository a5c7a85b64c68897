"""All registered queries; importing a module registers its queries."""

from . import forecasting, jobs, monitoring, preparation, profiling  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
