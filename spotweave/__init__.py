"""In-situ sequencing analytics as PySpark DataFrame operators."""
