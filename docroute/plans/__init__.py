from docroute.plans import archive_queries, bundle_queries, dimension_queries, file_queries, intake_queries, ledger_queries, linking_queries, monthly_queries, queue_queries, reconcile_queries, report_queries, thread_queries  # noqa: F401
