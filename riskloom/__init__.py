"""riskloom: tabular risk scoring and model monitoring as Spark DataFrame operators."""

__version__ = "0.1.0"
