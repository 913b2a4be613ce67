"""Customer-base analytics on Spark: cleaning, segmentation, churn and campaign design."""

__version__ = "0.1.0"
