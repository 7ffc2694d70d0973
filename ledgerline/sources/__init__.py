"""Reading untidy files and writing results."""
