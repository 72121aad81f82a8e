"""Column-expression helpers; every one returns a JVM-side Column.

money  - text at rest -> decimal(10,2) in queries -> decimal(38,2) out
text   - slugs, padding, venue labels
time   - timestamps, week starts, Pacific conversions, literals
"""
