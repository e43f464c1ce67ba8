"""Column expressions: dates, feed paths and weekly KPIs."""
