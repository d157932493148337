"""Writers: text, tables, documents and report lines."""
