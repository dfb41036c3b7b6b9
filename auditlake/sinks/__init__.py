"""Writers: archive objects, manifests, set-aside files and the Parquet copy."""
