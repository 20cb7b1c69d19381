"""tallgrass: text statistics, retrieval, graph ranking, relational reports,
linear classifiers and windowed event counts as Spark DataFrame operators."""

__version__ = "0.1.0"
