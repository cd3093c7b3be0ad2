"""Table-to-table operators.  ``keys`` names the series columns; an empty list is one series."""
