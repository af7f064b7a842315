"""Writers: lake tables, exports, JDBC and the check log."""
