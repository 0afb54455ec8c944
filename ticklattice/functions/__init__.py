"""Column functions."""

from .scalars import *  # noqa: F403
