"""All registered queries, grouped by product."""

from . import registry
from .registry import ORACLE, QUERIES

from . import (  # noqa: E402,F401
    audience,
    engagement,
    estimates,
    history,
    operators,
    paths,
    pricing,
    quality,
)

registry.resolve()
