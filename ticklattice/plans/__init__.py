"""Composite queries: the entry points for users. All take many symbols and days at once."""

from .reports import *  # noqa: F403
from .verify import listed_files, verify_changed  # noqa: F401
