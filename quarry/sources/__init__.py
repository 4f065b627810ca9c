"""Scans, sources and sinks."""
from quarry.sources.io import *  # noqa: F401,F403
