"""Reading, landing, writing and recording datasets."""
