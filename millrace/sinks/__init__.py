"""Writers: files, snapshot tables, documents, JDBC."""
