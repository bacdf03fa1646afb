"""Building blocks of the plans: joins to zones, quality rules, rollups and integrity checks."""
