"""Card-transaction risk analytics written as Spark DataFrame operators."""
