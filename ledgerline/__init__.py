"""Customer segmentation jobs on Spark: snapshots, spend ladder, reports."""
