"""Reading and writing: tables, files, partitions, quarantine, merges."""
