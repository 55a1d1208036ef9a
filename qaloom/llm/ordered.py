"""Places of rows in the order of their group, as the library has them."""

from qaloom.ordered import numbered

__all__ = ["numbered"]
