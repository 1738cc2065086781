"""The query catalogue: each entry runs one operator over whole tables, with SQL for the same result."""

from catalogue import checks, clean, feeds, load, merge, publish, shape  # noqa: F401
from catalogue.base import CATALOGUE

__all__ = ["CATALOGUE"]
