"""eventweave: an event knowledge graph engine on Spark DataFrames."""

__version__ = "0.1.0"
