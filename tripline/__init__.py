"""tripline: ride-record checking, enrichment, rollups and reports on Spark."""
