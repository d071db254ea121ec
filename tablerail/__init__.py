"""tablerail: a table-driven URL → page → summary pipeline as Spark DataFrame operators."""

__version__ = "0.1.0"
