"""ticketflow: field-ticket and device-recovery analytics as Spark DataFrame plans."""

from .config import FIXTURE, Config

__all__ = ["Config", "FIXTURE"]
