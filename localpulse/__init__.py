"""Local-market analytics as DataFrame operators on Spark."""
