"""The business questions: operators bound to the columns of the two tables."""
