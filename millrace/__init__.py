"""millrace: a PySpark-native library for episodic time-series and corpus data."""

__version__ = "0.1.0"
