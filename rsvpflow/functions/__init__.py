"""Scalar functions (F1–F12) as native Column expressions — no Python UDFs."""

from rsvpflow.functions.scalars import *  # noqa: F401,F403
