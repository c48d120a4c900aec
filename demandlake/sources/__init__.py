"""Reading and writing: CSV datasets and exports, file listings, the consolidated table."""
