"""Built tables and the reports that read them."""
