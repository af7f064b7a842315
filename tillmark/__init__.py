"""tillmark: retail demand analytics as Spark DataFrame operators."""
