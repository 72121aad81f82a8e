"""boxoffice — ticket-sales analytics as Spark DataFrame jobs.

Layout:
    sources/    table loading, fixture derivation, landing write/read, raw shapes
    functions/  column-expression helpers (money, text, time)
    operators/  the derived datasets: ingest, facts, reports, manifest, delivery
    plans/      the query registry and the DuckDB oracle SQL
    streaming/  Structured Streaming jobs over the same functions
"""

from boxoffice.session import get_spark, checkpoint_dir  # noqa: F401
