"""Writing tables and views."""
