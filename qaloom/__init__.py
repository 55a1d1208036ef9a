"""qaloom: question/answer dataset building as Spark DataFrame operations."""

from .rules import Rules

__all__ = ["Rules"]
