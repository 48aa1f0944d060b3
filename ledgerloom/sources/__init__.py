from ledgerloom.sources.tables import TABLES, load_csv, load_table, load_tables, row_counts

__all__ = ["TABLES", "load_csv", "load_table", "load_tables", "row_counts"]
