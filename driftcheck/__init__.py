"""driftcheck: table parity and run diagnosis as Spark DataFrame plans.

Modules:
  operators.parity    baseline-vs-target checks (registry of check names), rollup,
                      schema diff, row diffs, fleet report, validation writes
  operators.logs      log reduction, exception blocks, grep, stream merge, job status
  operators.triage    rule matching, diagnosis parsing, routing and its writes,
                      approvals, cost, usage, rule growth, scoring
  operators.confmap   configuration-map merge / default / strip / set, text edits,
                      manifest conformance
  operators.runstate  append-only change-log fold, listings, timelines, report rows
  streaming.streams   Structured Streaming alarms, routing, state fold, completion watch
  sources             driver tables, log files, rule and check specs, file sinks
  functions           Python-compatible text helpers, dense numbering, bounded broadcast
  plans               registered queries over the driver tables and their DuckDB oracles
  jobs                spark-submit entry points (validate, triage)
  session             session settings and the shared checkpoint folder
"""

__version__ = "0.1.0"
