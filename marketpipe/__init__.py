"""End-of-day market data as tables: DataFrame -> DataFrame operators on Spark."""
