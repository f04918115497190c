"""Where exam tables come from: parquet fixtures, JDBC queries, the catalog,
text files, and parameterised SQL over registered views."""
