"""Query plans over the driver tables, one module per family.

Importing this package fills :data:`QUERIES` and :data:`ORACLES`.
"""

from assay.plans.registry import ORACLES, QUERIES  # noqa: F401
from assay.plans import validation, scalars, suites, diffs, manifests, reports, corpus, tenancy, io, streams  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLES"]
