"""saleloom: sales cleaning, star schema, KPI marts and reports as Spark DataFrame plans."""
