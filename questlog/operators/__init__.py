"""KPI and dashboard operators: DataFrame in, DataFrame out."""
