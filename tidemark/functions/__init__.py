"""Column functions: text, keywords, dates, ids; Arrow UDFs only in arrow.py."""
