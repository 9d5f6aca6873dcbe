"""Weekly store-sales reporting and forecasting as Spark DataFrame operators."""
