"""Reading sessions and dimension snapshots, loading snapshots, writing reports."""
