"""Sales KPI engine on Spark: clean raw order tables, compute KPIs, shape and write the results."""
