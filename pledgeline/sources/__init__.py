"""Input tables: schemas, readers, and the mapping of the sample star schema onto the model."""
