"""Table scans, the derived fixture tables and the ad-log line source."""
