"""Every query of the engine itself; importing a module registers what it holds."""

from curatio.plans import coverage, curation, joins_and_names, pages, publishing, resolution, streams  # noqa: F401
from curatio.plans.registry import ORACLES, QUERIES  # noqa: F401
