from starloom.plans.star import build_star, build_dimensions, build_facts, TABLES, DIMENSIONS, FACTS
from starloom.plans import analytics, checks, dims, facts

__all__ = ["build_star", "build_dimensions", "build_facts", "TABLES", "DIMENSIONS", "FACTS",
           "analytics", "checks", "dims", "facts"]
