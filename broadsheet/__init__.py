"""Article analytics as Spark jobs: ingest, clean, enrich, upsert, search and analyse."""
