"""What the driver sees of this subpackage."""

import corpus_pipeline

from .queries import ORACLES
from .queries import QUERIES as OPERATORS

QUERIES = OPERATORS | {"pipeline": corpus_pipeline.run}

__all__ = ["ORACLES", "QUERIES"]
