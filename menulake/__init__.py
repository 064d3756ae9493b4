"""menulake: menu and nutrition data pipelines as Spark DataFrame jobs."""

__version__ = "0.1.0"
