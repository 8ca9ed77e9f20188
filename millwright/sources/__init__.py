"""Reading and writing table sets, staging, and views over the sample tables."""
