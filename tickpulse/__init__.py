"""tickpulse: post sentiment x market prices on Spark, batch and streaming."""

__version__ = "0.1.0"
