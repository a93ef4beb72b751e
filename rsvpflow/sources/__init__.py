"""Scans, sources and sinks."""

from rsvpflow.sources.tables import *  # noqa: F401,F403
from rsvpflow.sources.sinks import *  # noqa: F401,F403
