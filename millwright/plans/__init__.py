"""Plans over whole table sets."""
