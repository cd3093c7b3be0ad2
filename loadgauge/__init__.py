"""loadgauge: web-traffic load, forecast and capacity analytics as Spark jobs."""
