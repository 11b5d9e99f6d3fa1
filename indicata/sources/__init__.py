"""Reading and writing tables: schemas, CSV and Parquet, sidecars, manifests, archives."""
