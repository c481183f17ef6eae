"""The operators over unbounded observations."""
