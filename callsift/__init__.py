"""callsift: intent mining over conversation transcripts as Spark DataFrame jobs."""
