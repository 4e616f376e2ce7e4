"""Writers."""
from lathework.sinks.writers import *  # noqa: F401,F403
