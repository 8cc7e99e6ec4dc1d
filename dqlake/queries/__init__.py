from . import columns, dimensions, ingestion, metrics, quality, resolution, validation  # noqa: F401 (register)
from .registry import ORACLES, QUERIES
