"""Landing, scans and test fixtures."""
