"""staylens: review analytics as composable Spark DataFrame and Column functions."""
