"""DataFrame -> DataFrame operators: sessions, derived layer, health, ingest, journeys."""
