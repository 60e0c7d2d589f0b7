"""Keep a searchable vector table in step with business records, as Spark jobs."""
