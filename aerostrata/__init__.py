"""A PySpark-native engine for hourly environmental readings keyed by place and time."""
