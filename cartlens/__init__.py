"""Web-shop clickstream analytics as Spark plans: DataFrames in, one lazy DataFrame out."""

__version__ = "0.1.0"
