"""The three finished tables."""

from .accounts import accounts_model
from .carriers import carriers_model
from .drivers import drivers_model

__all__ = ["accounts_model", "carriers_model", "drivers_model"]
