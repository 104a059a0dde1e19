"""Smart-meter data pipelines as PySpark DataFrame operators."""
