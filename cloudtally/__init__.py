"""Cloud cost and service-reliability analytics as Spark DataFrame operators and plans."""

from cloudtally.limits import Limits

__all__ = ["Limits"]
