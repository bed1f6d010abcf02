"""All registered queries."""

from .base import ORACLES, QUERIES
from . import augmenting, evaluation, learning, margins, models, profiling, responses, sampling, search, streams, texts, weak  # noqa: F401
