"""DataFrame operators on station records."""
