"""Cell reliability analytics expressed as Spark DataFrame / SQL operators."""

__version__ = "0.1.0"
