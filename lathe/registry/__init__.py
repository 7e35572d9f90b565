"""All checked queries; importing a module registers its queries."""

from lathe.registry.base import QUERIES, ORACLES  # noqa: F401


def load_all():
    from lathe.registry import fitting, scalars, profiling, relations, core, routes, composites, modeling, streams  # noqa: F401
    return QUERIES, ORACLES
