"""Connected components of a distributed edge list, shared with the rest of the library."""

from storyloom.plans.graph import connected_components

__all__ = ["connected_components"]
