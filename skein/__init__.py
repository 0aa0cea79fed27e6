"""A PySpark-native engine for governing agent trajectories and training data."""
