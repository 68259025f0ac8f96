"""corvid: retrieval, text preparation and evaluation as Spark dataflows."""

__version__ = "0.1.0"
