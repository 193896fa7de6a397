"""Client-grain feature stores and default scoring on Spark."""
