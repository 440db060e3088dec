"""Scans: text directories, station lists, archives, snapshots."""
