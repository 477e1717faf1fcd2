"""Ad-event analytics on Spark: topic ingest, curation, campaign metrics and reconciliation."""

__version__ = "0.1.0"
