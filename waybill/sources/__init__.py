"""Reading and writing: CSV feeds, message topics, bronze JSON, tables, the serving store."""
