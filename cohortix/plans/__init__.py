"""End-to-end jobs: segmentation, prediction, batch scoring and reporting."""
