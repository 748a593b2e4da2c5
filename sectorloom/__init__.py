"""Sector coverage marts: water points, coverage, households and schools on Spark."""
