"""Part of the linkage engine."""
