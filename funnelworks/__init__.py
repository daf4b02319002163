"""Commercial-funnel analytics on Spark: cleaning, quality gate, star schema, views, analyses and measures."""
