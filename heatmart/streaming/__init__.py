"""Continuous forms of the append and of the heat-day report."""
