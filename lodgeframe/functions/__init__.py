"""Column-level functions used across operators."""

from .scalar import *  # noqa: F401,F403
