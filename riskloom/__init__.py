"""riskloom: risk scoring, model evaluation and drift monitoring as Spark DataFrame operators."""

__version__ = "0.1.0"
