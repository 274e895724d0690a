"""End-to-end jobs: coverage, combine, quality control and variant lists."""
