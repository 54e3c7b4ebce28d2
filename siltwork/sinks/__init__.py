"""Writers: files, tables, JDBC and message topics."""
