"""DataFrame -> DataFrame operators: contracts, data quality, dedup, change
data, dimensional model, reports and set utilities."""
