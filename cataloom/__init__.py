"""cataloom: media-catalogue curation written as Spark DataFrame jobs."""
