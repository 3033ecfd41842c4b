from .helpers import clashing, edge, nothing  # noqa: F401
