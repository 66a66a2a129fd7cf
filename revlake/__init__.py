"""Revenue analytics as Spark table operators: ingest, clean, aggregate, explore, forecast, monitor."""
