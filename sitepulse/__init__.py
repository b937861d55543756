"""Analytics over hourly vehicle counts per junction, written as Spark DataFrame operators."""
