"""Writers: JDBC (append / overwrite with or without truncate / error /
ignore), catalog tables by position, target-table DDL, sharded layouts and
plain files."""
