"""Jobs over several tables: merging extracts and publishing releases."""
