"""poselake: Spark-native analytics for virtual-screening campaigns."""

__version__ = "0.1.0"
