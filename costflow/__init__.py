"""Landing nested cost-and-usage Parquet feeds as flat, typed, partitioned tables."""
