"""Clinical extracts to the OMOP Common Data Model, as Spark DataFrame plans."""
