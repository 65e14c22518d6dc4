"""The daily jobs: pure DataFrame plans plus the step that merges them into tables."""
