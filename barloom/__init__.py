"""barloom: price-bar analytics for Spark.

Every operator takes a DataFrame of daily bars (``company_name, Date, Open,
High, Low, Close, Volume``; one row per company and day) and returns a
DataFrame. Nothing is collected inside an operator, all symbols are handled in
one pass, and company, year and date arguments are optional filters.
"""
