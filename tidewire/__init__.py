"""tidewire: a PySpark-native analytics engine for news and event intelligence."""
