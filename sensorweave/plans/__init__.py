"""Named query plans.  Importing ``catalog`` registers every query."""
