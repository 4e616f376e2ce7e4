"""Readers."""
from lathework.sources.readers import *  # noqa: F401,F403
