"""Column functions: text, dates, URLs, keys and places. All but two are built from native expressions."""
