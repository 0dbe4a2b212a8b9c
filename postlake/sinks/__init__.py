"""Table writers: partition overwrite, replace-where, publish, changes."""
