"""Named results: source preparation, KPI tables, the employee table and its analytics."""
