"""Connected components, as the library has them."""

from qaloom.graph import components, forest

__all__ = ["components", "forest"]
