"""postlake: forum-post analytics layers (raw → bronze → silver → gold) on Spark."""

__version__ = "0.1.0"
