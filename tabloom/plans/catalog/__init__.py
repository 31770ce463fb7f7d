"""The registered queries, by family."""

from importlib import import_module

FAMILIES = ("sources", "relational", "scalars", "quality", "statistics", "modelling", "privacy", "streams")


def load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
