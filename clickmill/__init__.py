"""Analytics jobs over text and click logs, written as Spark DataFrame operators."""
