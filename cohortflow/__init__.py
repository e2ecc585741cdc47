"""cohortflow: clinical-event analytics written as Spark DataFrame programs."""
