"""orderlens: customer-loyalty and delivery analytics as Spark DataFrame pipelines.

Layout:
  sources/    loading the input tables and binding column roles; sinks
  functions/  column expressions (cleaning, lists, time, aggregation helpers)
  operators/  reusable DataFrame operators (ranking with ties, null-aware
              anti join, zero-filled calendars, list expansion, cleaning)
  plans/      one pipeline per analytics question, the query registry and
              the DuckDB oracle text
"""

__all__ = ["session"]
