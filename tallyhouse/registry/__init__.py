"""Every registered query and its SQL twin."""
