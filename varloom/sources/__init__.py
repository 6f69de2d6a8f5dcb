"""Readers, writers and catalog helpers."""

from varloom.sources.catalog import *  # noqa: F401,F403
from varloom.sources.readers import *  # noqa: F401,F403
from varloom.sources.writers import *  # noqa: F401,F403
