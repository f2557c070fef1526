"""readloom: targeted read assembly and read-set analytics as Spark jobs."""

__version__ = "0.1.0"
