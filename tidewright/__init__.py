"""tidewright: incremental table mirroring and batch data quality on PySpark."""
